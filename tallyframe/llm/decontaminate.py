"""Benchmark decontamination by template windows with consistent slots.

Texts and benchmark items are turned into templates: numbers become ``<num>``, units behind a
number ``<unit>``, capitalised words inside a sentence ``<name>``; all other words are lower
case without punctuation. Windows of ``WIDTH`` template words are hashed and hash-joined, so a
question with other numbers, names or units still meets its original. For each document and
item that meet, the slots of all matched windows are lined up: a re-parameterised question
replaces each value of the item by one value throughout. Matched windows of one offset between
document and item are one occurrence, judged by itself: it is contaminating if enough windows
match and at least ``MIN_CONSISTENT`` of the item's slot values in them have one counterpart. A
pair is contaminated if one of its occurrences is, or, where words were put in or left out, if
all its windows together are; the counts reported are those of the best occurrence.

The benchmark side of the join is counted first. Up to ``BROADCAST_ROWS`` windows (16 bytes
each) it is broadcast; beyond that both sides are shuffled, the benchmark side repeated for
``SALTS`` salts so that a passage in a third of all documents is spread. Windows of documents
are exploded as plain numbers; texts are read again only for documents with a match.

Defined cases: null and empty texts and items have no windows; windows with fewer than
``MIN_LITERAL`` words outside slots are too common to tell as templates and are not used as such.
Items without any other window, that is those of fewer than ``WIDTH`` words or full of slots, are
searched word by word as they stand, but for case and punctuation: in windows of ``WIDTH`` words,
or of all their words if these are fewer. So exact copies of them are found, whatever their length;
rows with the same ``doc_id`` and text count once;
a null ``doc_id`` or ``item_id`` is matched like any other and reported as null; empty tables
give an empty result (``apply`` then keeps everything); other columns, whatever their names,
are passed on by ``apply``. The work is linear in the length of a text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tallyframe.llm.rows import BLANKS, WORD_BREAK, boxed, stored

WIDTH = 8
MIN_LITERAL = 5
MIN_WINDOWS = 3
MIN_CONSISTENT = 0.8
BROADCAST_ROWS = 250_000
BROADCAST_SLOTS = 50_000  # matched windows with slots, some 200 bytes each
SALTS = 16

#: Unit words taken as slots behind a number.
UNITS = (
    "mm cm m km in inch inches ft foot feet yd yard yards mi mile miles mg g kg gram grams kilogram kilograms t ton tons oz lb lbs "
    "ml l liter liters litre litres gal gallon gallons s sec second seconds min minute minutes h hr hour hours day days week weeks "
    "month months year years hz khz mhz ghz w kw mw kwh v a k c f n j kj cal kcal pa kpa bar mph kmh "
    "usd eur gbp dollar dollars cent cents euro euros pound pounds"
).split()

_BARE = r"(?<![^ ])[^\p{L}\p{N} ]+(?![^ ])"  # words without a letter or digit
_NAME = r"(?<=[\p{Ll}\p{N},;:)] )\p{Lu}\p{Ll}+(?![\p{L}\p{N}])"
_NUMBER = r"(?<![\p{L}\p{N}<])[+-]?[$€£]?\p{N}+(?:[.,:/]\p{N}+)*%?"
_UNIT = r"(?<=<num> )(?:" + "|".join(UNITS) + r")(?![\p{L}\p{N}])|(?<=<num>)(?:" + "|".join(UNITS) + r")(?![\p{L}\p{N}])"


def cleaned(text: Column) -> Column:
    """Single blanks, no words without letters or digits; template and text then align word by word."""
    blanks = F.btrim(F.regexp_replace(F.coalesce(text, F.lit("")), WORD_BREAK, " "), F.lit(BLANKS))
    return F.btrim(F.regexp_replace(F.regexp_replace(blanks, _BARE, ""), " +", " "), F.lit(" "))


def template(clean: Column) -> Column:
    """Template words of a cleaned text, as many as it has words."""
    t = F.lower(F.regexp_replace(clean, _NAME, "<name>"))
    t = F.regexp_replace(F.regexp_replace(t, _NUMBER, "<num>"), _UNIT, "<unit>")
    return F.split(F.regexp_replace(t, r"[^\p{L}\p{M}\p{N}<> ]+", ""), " ")


def _pairs(array: str, step: int) -> str:
    """SQL: hashes of elements ``step`` apart, one for each that has a partner."""
    return f"transform(array({array}), h -> zip_with(slice(h, 1, size(h) - {step}), slice(h, {step} + 1, size(h) - {step}), (x, y) -> xxhash64(x, y)))[0]"


def window_hashes(words: str) -> Column:
    """Hashes of all windows of ``WIDTH`` words, by doubling: 1, 2, 4, 8 words."""
    h, n = f"transform({words}, x -> xxhash64(x))", 1
    while n < WIDTH:
        h, n = _pairs(h, n), 2 * n
    return F.expr(f"if(size({words}) < {WIDTH}, cast(array() as array<bigint>), {h})")


def document_windows(docs: DataFrame) -> DataFrame:
    """``did``, ``thash``, ``pos``, ``window`` of every template window."""
    t = docs.select(F.col("doc_id").cast("bigint").alias("did"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("thash"),
                    template(cleaned(F.col("text"))).alias("words"))
    return t.select("did", "thash", F.posexplode(window_hashes("words")).alias("pos", "window"))


def literal(clean: Column) -> Column:
    """Words of a cleaned text in lower case, without punctuation at either end."""
    return F.split(F.regexp_replace(F.lower(clean), r"(?<![^ ])[^\p{L}\p{N} ]+|[^\p{L}\p{M}\p{N} ]+(?![^ ])", ""), " ")


def literal_windows(words: str, width: str) -> Column:
    """Hashes of all windows of ``width`` words as they stand."""
    return F.expr(f"if(size({words}) < {width}, cast(array() as array<bigint>), "
                  f"transform(sequence(0, greatest(size({words}) - {width}, 0)), k -> xxhash64(slice({words}, k + 1, {width}), {width}, 'literal')))")


def item_windows(benchmark: DataFrame) -> DataFrame:
    """``item_id``, ``text_of`` (set if searched as it stands), ``width``, ``at``, ``window``, ``slots`` and ``n_windows`` of every benchmark window."""
    clean = benchmark.select(F.col("item_id"), cleaned(F.col("text")).alias("clean")).where("clean <> ''")
    t = clean.select("item_id", "clean", F.split("clean", " ").alias("raw"), template(F.col("clean")).alias("words"))
    t = t.withColumn("hashes", window_hashes("words"))
    slots = f"filter(transform(sequence(0, {WIDTH - 1}), k -> struct(k as k, words[at + k] as kind, raw[at + k] as value)), s -> s.kind like '<%')"
    t = t.withColumn("found", F.expr(f"filter(transform(hashes, (h, at) -> struct(at as at, h as window, {slots} as slots)), w -> size(w.slots) <= {WIDTH - MIN_LITERAL})"))
    none = F.lit(None).cast("bigint")
    w = t.select("item_id", none.alias("text_of"), F.lit(WIDTH).alias("width"), F.explode("found").alias("w")).select("item_id", "text_of", "width", "w.*")
    whole = t.where("size(found) = 0").select("item_id", F.xxhash64("clean").alias("text_of"), literal(F.col("clean")).alias("own")).withColumn(
        "width", F.least(F.size("own"), F.lit(WIDTH)))
    whole = whole.select("item_id", "text_of", "width", F.posexplode(literal_windows("own", "width")).alias("at", "window"))
    w = w.unionByName(whole.withColumn("slots", F.expr("cast(array() as array<struct<k: int, kind: string, value: string>>)")))
    w = w.groupBy("item_id", "text_of", "width", "window").agg(F.min_by("slots", "at").alias("slots"), F.min("at").alias("at"))
    per_item = w.groupBy(F.col("item_id").alias("i"), F.col("text_of").alias("o")).agg(F.count("*").alias("n_windows"))
    return w.join(per_item, F.col("item_id").eqNullSafe(F.col("i")) & F.col("text_of").eqNullSafe(F.col("o"))).drop("i", "o")


def literal_document_windows(docs: DataFrame, widths: list[int]) -> DataFrame:
    """As ``document_windows``, of words as they stand."""
    t = docs.select(F.col("doc_id").cast("bigint").alias("did"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("thash"),
                    literal(cleaned(F.col("text"))).alias("own"))
    each = [t.select("did", "thash", F.posexplode(literal_windows("own", str(n))).alias("pos", "window")) for n in widths]
    out = each[0]
    for e in each[1:]:
        out = out.unionByName(e)
    return out


def matches(docs: DataFrame, benchmark: DataFrame, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Document windows that equal a benchmark window, with the item's slots."""
    items = stored(item_windows(benchmark), "item-windows")
    found = document_windows(docs)
    widths = sorted(r["width"] for r in items.where("text_of is not null").select("width").distinct().collect())  # 1 to WIDTH
    if widths:
        found = found.unionByName(literal_document_windows(docs, widths))
    keys = items.select("window").distinct()
    if keys.count() <= broadcast_rows:
        hits = found.join(F.broadcast(keys), "window", "left_semi")
    else:
        salts = keys.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        hits = found.withColumn("salt", F.pmod(F.xxhash64("did", "pos"), F.lit(SALTS)).cast("int")).join(salts, ["window", "salt"], "left_semi").drop("salt")
    hits = stored(hits.distinct(), "window-hits")
    salted = items.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return stored(
        hits.withColumn("salt", F.pmod(F.xxhash64("did", "pos"), F.lit(SALTS)).cast("int")).join(salted, ["window", "salt"]).drop("salt", "window", "width"), "matches")


def occurrences(hits: DataFrame) -> DataFrame:
    """Matches with ``parts``: all of the pair, those of one offset, and those of a stretch of nearby offsets."""
    offset = F.col("pos") - F.col("at")
    order = Window.partitionBy("did", "thash", "item_id", "text_of").orderBy("pos", "at")
    jump = F.coalesce((F.abs(offset - F.lag(offset).over(order)) > WIDTH).cast("int"), F.lit(0))
    stretch = F.sum("jump").over(order)
    of = F.coalesce(F.concat(F.lit(" of "), "text_of"), F.lit(""))
    return hits.withColumn("jump", jump).withColumn("parts", F.array(
        F.concat(F.lit("all"), of), F.concat(F.lit("offset "), offset, of), F.concat(F.lit("stretch "), stretch, of))).drop("jump", "text_of")


def verdicts(docs: DataFrame, benchmark: DataFrame, min_windows: int = MIN_WINDOWS,
             min_consistent: float = MIN_CONSISTENT, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """A row per document and item that share a template window: counts and ``contaminated``."""
    hits = occurrences(matches(docs, benchmark, broadcast_rows))
    same_pair = ["did", "thash", "item_id"]
    same = [*same_pair, "part"]
    met = hits.withColumn("part", F.explode("parts")).groupBy(*same).agg(F.count_distinct("at").alias("n_matched"), F.max("n_windows").alias("n_windows"))
    with_slots = hits.where(F.size("slots") > 0)
    slotted = with_slots.groupBy("did", "thash").agg(F.collect_list(F.struct("pos", "item_id", "parts", "slots")).alias("hits"))
    if with_slots.count() <= min(broadcast_rows, BROADCAST_SLOTS):
        slotted = F.broadcast(slotted)  # else the texts are shuffled to meet their matches
    raw = docs.select(F.col("doc_id").cast("bigint").alias("d"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("h"), cleaned(F.col("text")).alias("clean"))
    # one row per slot of a matched window; a document's own windows bound what meets here
    pairs = (
        raw.join(slotted, F.col("d").eqNullSafe(F.col("did")) & (F.col("h") == F.col("thash")))
        .select("did", "thash", F.split("clean", " ").alias("raw"), "hits")
        .select("did", "thash", F.explode(F.expr(
            "flatten(transform(hits, h -> transform(h.slots, s -> struct(h.item_id as item_id, h.parts as parts, s.kind as kind, s.value as theirs, raw[h.pos + s.k] as ours))))")).alias("s"))
        .select("did", "thash", "s.*").withColumn("part", F.explode("parts"))
    )
    slots = pairs.groupBy(*same, "kind", "theirs").agg(F.min("ours").alias("low"), F.max("ours").alias("high")).groupBy(*same).agg(
        F.count("*").alias("n_slots"), F.count_if(F.col("low") == F.col("high")).alias("n_consistent"),
        F.count_if((F.col("low") != F.col("theirs")) | (F.col("high") != F.col("theirs"))).alias("n_changed"))
    s = slots.select(F.col("did").alias("d"), F.col("thash").alias("h"), F.col("item_id").alias("i"), F.col("part").alias("p"), "n_slots", "n_consistent", "n_changed")
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    out = met.join(s, F.col("did").eqNullSafe(F.col("d")) & (F.col("thash") == F.col("h")) & F.col("item_id").eqNullSafe(F.col("i")) & (F.col("part") == F.col("p")), "left").select(
        "did", "thash", "item_id", "n_matched", "n_windows", zero("n_slots"), zero("n_consistent"), zero("n_changed"))
    out = out.withColumn("contaminated", (F.col("n_matched") >= F.least(F.lit(min_windows), "n_windows"))
                         & (F.col("n_consistent") >= min_consistent * F.col("n_slots")))
    counts = ["contaminated", "n_matched", "n_windows", "n_consistent", "n_slots", "n_changed"]
    best = out.groupBy(*same_pair).agg(F.max(F.struct(*counts)).alias("best"))
    return best.select(*same_pair, *[f"best.{c}" for c in ("n_matched", "n_windows", "n_slots", "n_consistent", "n_changed", "contaminated")])


def apply(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The documents that no benchmark item contaminates, with the columns they came with."""
    bad = stored(verdicts(docs, benchmark, **options).where("contaminated").select("did", "thash").distinct(), "contaminated")
    if bad.count() <= BROADCAST_ROWS:
        bad = F.broadcast(bad)
    rows = boxed(docs, d=F.col("doc_id").cast("bigint"), h=F.xxhash64(F.coalesce("text", F.lit(""))))
    return rows.join(bad, F.col("d").eqNullSafe(F.col("did")) & (F.col("h") == F.col("thash")), "left_anti").select("row.*")
