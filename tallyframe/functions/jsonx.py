"""JSON access with scalar/sub-document separation.

Parse a text column once with :func:`parsed`, then read many paths from the variant.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _c(x) -> Column:
    return x if isinstance(x, Column) else F.col(x)


def parsed(text) -> Column:
    """Variant of a JSON text, NULL when malformed."""
    return F.try_parse_json(_c(text))


def path_of(*names: str) -> str:
    """Variant path from field names; quoting keeps dotted and non-ASCII names intact."""
    return "$" + "".join(f"['{n}']" for n in names)


def json_raw(variant, path: str) -> Column:
    """Node at ``path`` as text, nested nodes as their JSON text.

    Enough wherever the text is cast afterwards: the text of an object never casts.
    """
    return F.try_variant_get(_c(variant), path, "string")


def json_scalar(variant, path: str) -> Column:
    """Scalar at ``path`` as text; objects, arrays and missing paths give NULL."""
    raw = json_raw(variant, path)
    # only a text that looks nested needs the costlier type test
    plain = ~(raw.startswith("{") | raw.startswith("["))
    nested = F.schema_of_variant(F.try_variant_get(_c(variant), path, "variant")).rlike("^(OBJECT|ARRAY)")
    return F.when(plain, raw).when(~nested, raw)


def json_number(variant, path: str, type_: str = "decimal(18,2)") -> Column:
    """Scalar at ``path`` cast to a number, NULL when it is not one."""
    return json_raw(variant, path).try_cast(type_)


def json_array(variant, path: str) -> Column:
    """Array at ``path`` as ``array<variant>``, NULL when it is no array."""
    return F.try_variant_get(_c(variant), path, "array<variant>")


def json_text(variant, path: str) -> Column:
    """Sub-document at ``path`` serialised as JSON text."""
    return F.to_json(F.try_variant_get(_c(variant), path, "variant"))


def first_scalar(variant, *paths: str) -> Column:
    """First non-NULL scalar among alternative paths."""
    return F.coalesce(*[json_scalar(variant, p) for p in paths])


def double_encoded(variant, path: str) -> Column:
    """Variant behind a JSON text that itself holds JSON."""
    return F.try_parse_json(F.try_variant_get(_c(variant), path, "string"))


def entries_to_map(array, key, value) -> Column:
    """Map from an array of key-value elements; ``key``/``value`` map an element to a column."""
    return F.map_from_entries(F.transform(array, lambda x: F.struct(key(x), value(x))))
