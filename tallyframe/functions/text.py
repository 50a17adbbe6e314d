"""Text clean-up, flags, labels and identifier normalisation."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Spellings of true, and identifiers that stand for "none".
TRUE_WORDS = ["X", "TRUE", "1", "YES"]
DUMMY_IDENTIFIERS = [
    "0", "00", "000000000", "0000000000", "999999999", "9999999999", "NULL", "NONE", "NAN",
]


def _c(x) -> Column:
    return x if isinstance(x, Column) else F.col(x)


def blank_to_null(x) -> Column:
    t = F.trim(_c(x))
    return F.when(t != "", t)


def is_true_word(x) -> Column:
    return F.coalesce(F.upper(F.trim(_c(x))).isin(TRUE_WORDS), F.lit(False))


def placeholder_to_null(x, values) -> Column:
    c = _c(x)
    return F.when(~c.isin(values), c)


def normalize_identifier(x, upper_first: bool = False) -> Column:
    """Identifier reduced to ``A-Z0-9``.

    The default strips before upper-casing, so lower-case letters are lost; this is the
    documented behaviour. ``upper_first`` gives the case-insensitive form.
    """
    t = F.trim(_c(x))
    out = (F.regexp_replace(F.upper(t), "[^A-Z0-9]", "") if upper_first
           else F.upper(F.regexp_replace(t, "[^A-Z0-9]", "")))
    return F.when(out != "", out)


def real_identifier(x, upper_first: bool = False) -> Column:
    """Normalised identifier, NULL for dummies."""
    n = normalize_identifier(x, upper_first)
    return F.when(~n.isin(DUMMY_IDENTIFIERS), n)


def code_label(code, name, sep: str = " - ") -> Column:
    """``code - name``, or whichever of the two is present."""
    c, n = _c(code), _c(name)
    return F.coalesce(F.concat(c, F.lit(sep), n), c, n)


def segment_code(*parts, sep: str = "-") -> Column:
    """Parts joined in order; missing ones stay empty and trailing separators are cut."""
    joined = F.concat_ws(sep, *[F.coalesce(_c(p), F.lit("")) for p in parts])
    trimmed = F.regexp_replace(joined, f"({sep})+$", "")
    return F.when(trimmed != "", trimmed)


def words(x) -> Column:
    """Lower-cased words; letters and digits of any script count as word characters."""
    return F.filter(F.split(F.lower(_c(x)), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def query_map(query) -> Column:
    """Query string as map."""
    return F.str_to_map(_c(query), F.lit("&"), F.lit("="))


def path_segment(x) -> Column:
    """Lower case, everything but letters and digits becomes ``_``."""
    return F.regexp_replace(F.lower(_c(x)), "[^a-z0-9]", "_")
