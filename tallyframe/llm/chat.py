"""Quotation linking: conversations in reply order, without their quotes.

A line's quote level is the number of ``>`` in front of it. Neighbouring lines of one level form
a passage; an attribution line ("... wrote:") right before a quote belongs to the quote. Quoted
passages are cut into sentences, normalised (lower case, letters and digits only) and hashed, and
so is what each message says itself at level 0; a quoted sentence links to the message that said
it first, earlier in the same conversation. A message answers the message from which most of its
quoted sentences of the lowest level come, the later one on ties. Following these answers gives
each message the root of its thread and its depth; messages that quote nothing stand at depth 0 on
the main line of their conversation. ``conv_id, thread, turn`` is the reply order: an answer
always stands after what it answers.

Sentences are folded to their first speaker before the join, so a sentence repeated in a third of
all messages is one row there, and threads are followed by pointer jumping in joins; no window
and no group ever holds a whole conversation.

Defined cases: a null text is empty; rows with the same ``conv_id`` and ``turn`` are one message
for linking (each row keeps its own text); messages with a null ``conv_id`` form one
conversation; a null ``turn`` neither quotes nor is quoted and stands alone; sentences of fewer
than ``MIN_LETTERS`` letters or digits link nothing; quotes without a known origin are removed and
counted as unlinked; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tallyframe.llm.rows import stored

MIN_LETTERS = 8
_MARKS = r"^((?:[ \t]*>)*)"
_ATTRIBUTION = r"(?i)^.{0,200}\b(wrote|writes|schrieb|a écrit|escribió)\s*:\s*$"


def messages(conversations: DataFrame) -> DataFrame:
    """One row per input row: ids, role, text hash and its lines with level and body."""
    text = F.regexp_replace(F.coalesce(F.col("text"), F.lit("")), "\r\n?", "\n")
    lines = F.split(text, "\n", -1)
    leveled = F.transform(lines, lambda x: F.struct(
        F.length(F.regexp_replace(F.regexp_extract(x, _MARKS, 1), "[^>]", "")).alias("level"),
        F.regexp_replace(x, _MARKS + "[ ]?", "").alias("body")))
    return conversations.select(
        F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"), F.col("role").cast("string").alias("role"),
        text.alias("text"), F.when(F.contains(text, F.lit(">")), leveled).alias("lines"))


def _quoted() -> Column:
    """Lines of a message that are quotes or the attribution of one."""
    return F.expr(f"""transform(array(lines), ls -> filter(ls, (x, i) -> x.level > 0 or (i < size(ls) - 1
        and ls[least(i + 1, size(ls) - 1)].level > 0 and x.body rlike r'{_ATTRIBUTION}')))[0]""")


def _own() -> Column:
    return F.expr(f"""transform(array(lines), ls -> filter(ls, (x, i) -> not (x.level > 0 or (i < size(ls) - 1
        and ls[least(i + 1, size(ls) - 1)].level > 0 and x.body rlike r'{_ATTRIBUTION}'))))[0]""")


def clean_text() -> Column:
    """What the message says itself; blank lines left by quotes at either end go too."""
    own = F.array_join(F.transform(_own(), lambda x: x["body"]), "\n")
    return F.when(F.col("lines").isNull(), F.col("text")).otherwise(F.regexp_replace(own, r"^\s*\n|\n\s*$", ""))


def sentences(text: Column) -> Column:
    """Hashes of the normalised sentences of a text, without the short ones."""
    parts = F.transform(F.split(text, r"[.!?]+(?=\s|$)"), lambda s: F.regexp_replace(F.lower(s), r"[^\p{L}\p{M}\p{N}]+", ""))
    return F.transform(F.filter(parts, lambda s: F.char_length(s) >= MIN_LETTERS), lambda s: F.xxhash64(s))


def quoted_sentences(m: DataFrame) -> DataFrame:
    """``conv_id``, ``turn``, ``level``, ``sentence`` of every quoted sentence.

    Lines of one level and one run are joined first, so a quote that was wrapped anew still
    has the sentences of its origin. Runs are numbered inside the row.
    """
    lines = m.where("lines is not null").select("conv_id", "turn", _quoted().alias("quoted")).where(F.size("quoted") > 0)
    by_level = lines.select("conv_id", "turn", "quoted", F.explode(F.expr("array_distinct(transform(filter(quoted, x -> x.level > 0), x -> x.level))")).alias("level"))
    passage = F.expr("array_join(transform(quoted, x -> if(x.level = level, x.body, '\\n.\\n')), ' ')")  # another level ends a sentence
    return by_level.select("conv_id", "turn", "level", F.explode(sentences(passage)).alias("sentence"))


def answers(m: DataFrame) -> DataFrame:
    """``conv_id``, ``turn``, ``parent`` and counts of quoted and linked sentences."""
    quoted = stored(quoted_sentences(m).where("turn is not null"), "quoted")
    counts = quoted.groupBy("conv_id", "turn").agg(F.count("*").alias("n_quoted"), F.max("level").alias("max_level"))
    wanted = quoted.select("conv_id", "sentence").distinct()
    said = m.where("turn is not null").select("conv_id", "turn", F.explode(sentences(clean_text())).alias("sentence"))
    said = said.groupBy("conv_id", "sentence").agg(F.min("turn").alias("origin"))
    w = wanted.select(F.col("conv_id").alias("c"), F.col("sentence").alias("s"))
    said = said.join(w, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("sentence") == F.col("s")), "left_semi")
    linked = quoted.join(said.select(F.col("conv_id").alias("c"), F.col("sentence").alias("s"), "origin"),
                         F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("sentence") == F.col("s"))).where("origin < turn")
    votes = linked.groupBy("conv_id", "turn", "origin").agg(F.min("level").alias("level"), F.count("*").alias("n"))
    best = votes.groupBy("conv_id", "turn").agg(
        F.sum("n").alias("n_linked"), F.max(F.struct(-F.col("level"), "n", "origin")).alias("best"))
    b = best.select(F.col("conv_id").alias("c"), F.col("turn").alias("t"), "n_linked", F.col("best.origin").alias("parent"))
    return counts.join(b, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("turn") == F.col("t")), "left").drop("c", "t")


def threads(links: DataFrame) -> DataFrame:
    """``conv_id``, ``turn``, ``thread`` (its topmost ancestor) and ``depth`` of every answering message."""
    todo = stored(links.where("parent is not null").select("conv_id", "turn", F.col("parent").alias("thread"), F.lit(1).cast("bigint").alias("depth")), "threads")
    while True:
        up = todo.select(F.col("conv_id").alias("c"), F.col("turn").alias("t"), F.col("thread").alias("top"), F.col("depth").alias("more"))
        step = stored(todo.join(up, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("thread") == F.col("t")), "left").select(
            "conv_id", "turn", F.coalesce("top", "thread").alias("thread"), (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth"),
            F.col("top").isNotNull().alias("moved")), "threads")
        todo = step.drop("moved")
        if step.where("moved").isEmpty():
            return todo


def linked(conversations: DataFrame) -> DataFrame:
    """Every message without its quotes, with what it answers and its place in reply order."""
    m = messages(conversations)
    links = stored(answers(m), "answers")
    tops = threads(links).select(F.col("conv_id").alias("tc"), F.col("turn").alias("tt"), "thread", "depth")
    starts = m.groupBy("conv_id").agg(F.min("turn").alias("start")).select(F.col("conv_id").alias("sc"), "start")
    a = links.select(F.col("conv_id").alias("ac"), F.col("turn").alias("at"), "parent", "n_quoted", "n_linked", "max_level")
    said = m.select("conv_id", "turn", "role", clean_text().alias("clean"))
    out = said.join(a, F.col("conv_id").eqNullSafe(F.col("ac")) & (F.col("turn") == F.col("at")), "left")
    out = out.join(tops, F.col("conv_id").eqNullSafe(F.col("tc")) & (F.col("turn") == F.col("tt")), "left")
    out = out.join(starts, F.col("conv_id").eqNullSafe(F.col("sc")))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(c)
    return out.select(
        "conv_id", F.when(F.col("turn").isNotNull(), F.coalesce("thread", "start")).alias("thread"), "turn", "role",
        F.col("parent").alias("reply_to"), zero("depth"), zero("n_quoted"), zero("n_linked"), zero("max_level"), "clean")


ORACLE = f"""
WITH RECURSIVE m AS (
  SELECT row_number() OVER () AS rid, conv_id, turn, role, replace(replace(coalesce(text, ''), chr(13) || chr(10), chr(10)), chr(13), chr(10)) AS text FROM conversations),
l0 AS (SELECT rid, conv_id, turn, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM m WHERE contains(text, '>')),
l1 AS (SELECT rid, conv_id, turn, pos, length(regexp_replace(regexp_extract(line, '{_MARKS}', 1), '[^>]', '', 'g')) AS level,
              regexp_replace(line, '{_MARKS}[ ]?', '') AS body FROM l0),
l2 AS (SELECT *, level > 0 OR (coalesce(lead(level) OVER (PARTITION BY rid ORDER BY pos), 0) > 0
              AND regexp_matches(body, '{_ATTRIBUTION}')) AS quote FROM l1),
own AS (SELECT rid, regexp_replace(coalesce(string_agg(body, chr(10) ORDER BY pos) FILTER (NOT quote), ''), '^\\s*\\n|\\n\\s*$', '', 'g') AS clean FROM l2 GROUP BY rid),
c AS (SELECT m.rid, m.conv_id, m.turn, m.role, coalesce(own.clean, m.text) AS clean FROM m LEFT JOIN own USING (rid)),
lv AS (SELECT DISTINCT rid, level AS lev FROM l2 WHERE quote AND level > 0),
p AS (SELECT l2.rid, l2.conv_id, l2.turn, lv.lev AS level, string_agg(CASE WHEN l2.level = lv.lev THEN body ELSE chr(10) || '.' || chr(10) END, ' ' ORDER BY pos) AS passage
      FROM l2 JOIN lv USING (rid) WHERE quote GROUP BY ALL),
q AS (SELECT conv_id, turn, level, s FROM (SELECT conv_id, turn, level,
        regexp_replace(lower(unnest(regexp_split_to_array(passage || ' ', '[.!?]+\\s'))), '[^\\p{{L}}\\p{{M}}\\p{{N}}]+', '', 'g') AS s FROM p) WHERE length(s) >= {MIN_LETTERS}),
o AS (SELECT conv_id, s, min(turn) AS origin FROM (SELECT conv_id, turn,
        regexp_replace(lower(unnest(regexp_split_to_array(clean || ' ', '[.!?]+\\s'))), '[^\\p{{L}}\\p{{M}}\\p{{N}}]+', '', 'g') AS s FROM c) WHERE length(s) >= {MIN_LETTERS} GROUP BY ALL),
v AS (SELECT q.conv_id, q.turn, o.origin, min(q.level) AS level, count(*) AS n FROM q JOIN o ON q.conv_id IS NOT DISTINCT FROM o.conv_id AND q.s = o.s AND o.origin < q.turn GROUP BY ALL),
b AS (SELECT conv_id, turn, sum(n) AS n_linked, arg_max(origin, (-level, n, origin)) AS parent FROM v GROUP BY ALL),
a AS (SELECT conv_id, turn, count(*) AS n_quoted, max(level) AS max_level FROM q WHERE turn IS NOT NULL GROUP BY ALL),
t AS (SELECT conv_id, turn, parent AS thread, 1 AS depth FROM b
      UNION ALL SELECT t.conv_id, t.turn, b.parent, t.depth + 1 FROM t JOIN b ON t.conv_id IS NOT DISTINCT FROM b.conv_id AND t.thread = b.turn),
top AS (SELECT conv_id, turn, arg_max(thread, depth) AS thread, max(depth) AS depth FROM t GROUP BY ALL),
st AS (SELECT conv_id, min(turn) AS start FROM m GROUP BY ALL)
SELECT c.conv_id, CASE WHEN c.turn IS NOT NULL THEN coalesce(top.thread, st.start) END AS thread, c.turn, c.role, b.parent AS reply_to,
       CAST(coalesce(top.depth, 0) AS BIGINT) AS depth, CAST(coalesce(a.n_quoted, 0) AS BIGINT) AS n_quoted,
       CAST(coalesce(b.n_linked, 0) AS BIGINT) AS n_linked, CAST(coalesce(a.max_level, 0) AS BIGINT) AS max_level, c.clean
FROM c LEFT JOIN a ON c.conv_id IS NOT DISTINCT FROM a.conv_id AND c.turn = a.turn
       LEFT JOIN b ON c.conv_id IS NOT DISTINCT FROM b.conv_id AND c.turn = b.turn
       LEFT JOIN top ON c.conv_id IS NOT DISTINCT FROM top.conv_id AND c.turn = top.turn
       JOIN st ON c.conv_id IS NOT DISTINCT FROM st.conv_id
"""
