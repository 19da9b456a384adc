"""Chat formatting by quotation linking, in DataFrame functions only.

A line's quote level is the number of > it begins with. Consecutive quoted lines of one level are a passage, whose words are normalised
(A-Z lower-cased, white space to single spaces) and hashed. Messages offer their own (unquoted) text under the same hashes: the whole of
it, each paragraph, each line. A passage is joined to the messages of its conversation with a smaller turn: the whole text before a
paragraph before a line, then the largest turn. If none has the passage as such, its lines are joined singly, and the message with the
most of them counts, then the largest turn.

A message replies to the source of its first linked passage, outer levels first, and begins a branch there; a message without a linked
passage goes on where the turn before it is. reply_path sorts a conversation by replies: the path of its branch (place of each reply and
first turn of each branch) and the turn, so a reply comes after what it replies to and before later turns of that branch. body is the
own text without quotes, without lines that announce a quote, and without blank lines at both ends.

Only conversations with a quote are joined; others keep their turns. A conversation is never gathered: rows are keyed by conversation
and hash. The message a passage comes from is found as of its turn: passages and messages with its hash are put in the order of turns, and
the last message is carried forward within stretches of `stretch` turns, then from stretch to stretch. A line that every turn quotes thus
costs one row for each quote. Passages joined by their single lines are the exception: they meet every earlier message with one of them.

Defined cases: null texts are empty; null conv_id or turn stand for the smallest number (and come back as null); rows that share conv_id
and turn are one place in the conversation and keep their own bodies; rows equal in these, role and text are joined once and get equal
results; passages without words are none; an empty table gives an empty result.
"""

from __future__ import annotations

import string
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallymart.llm.shared import NO_ID, narrow, stored, table

MARKS = r"^(?:[ \t]*>)+"
#: Fixed value: how lines that announce a quote end.
ANNOUNCES = r"(?:wrote|schrieb|écrit|escribió):[ \t]*$"
BROADCAST_ROWS = 500_000
PLACE = ["conv", "turn", "mid"]


def level_of(line: Column) -> Column:
    found = F.regexp_extract(line, MARKS, 0)
    return F.length(found) - F.length(F.replace(found, F.lit(">"), F.lit("")))


def content_of(line: Column) -> Column:
    return F.regexp_replace(line, MARKS + "[ \t]?", "")


def normal(text: Column) -> Column:
    lowered = F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    return F.trim(F.regexp_replace(lowered, r"[\x09-\x0D\x20]+", " "))


def lines_of(text: Column) -> Column:
    return F.split(F.replace(text, F.lit("\r"), F.lit("")), "\n")


def own_lines(lines: Column) -> Column:
    announces = lambda x, i: x.rlike(ANNOUNCES) & F.coalesce(level_of(F.get(lines, i + 1)) > 0, F.lit(False))
    return F.filter(lines, lambda x, i: (level_of(x) == 0) & ~announces(x, i))


def body_of(text: Column) -> Column:
    own = F.array_join(own_lines(lines_of(text)), "\n")
    return F.when(~F.contains(text, F.lit(">")), F.replace(text, F.lit("\r"), F.lit(""))).otherwise(F.regexp_replace(own, r"^(?:[ \t]*\n)+|(?:\n[ \t]*)+$", ""))


@dataclass(frozen=True)
class Linked:
    """messages: one row per message; links: one row per linked passage (conv, turn, level, start line, source turn)."""

    messages: DataFrame
    links: DataFrame


def link_quotations(messages: DataFrame, stretch: int = 1024) -> Linked:
    number = lambda c: F.coalesce(F.col(c).cast("long"), F.lit(NO_ID))
    rows = messages.select(number("conv_id").alias("conv"), number("turn").alias("turn"), "role", F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumn("mid", F.xxhash64("role", "text"))
    quoting = rows.where(F.contains("text", F.lit(">")) & F.col("text").rlike(r"(?m)^[ \t]*>"))
    quoting = stored(quoting.select("conv").distinct(), "op1-quoting")
    some = narrow(quoting, BROADCAST_ROWS)
    mixed, plain = rows.join(some, "conv", "left_semi"), rows.join(some, "conv", "left_anti")

    links = stored(_links(mixed, stretch), "op1-links")
    first = F.min(F.struct("level", "start", "source"))
    branches = links.groupBy("conv", "turn").agg(first.alias("f")).select("conv", F.col("turn").alias("start"), F.col("f.source").alias("source"))
    turns = mixed.select("conv", "turn").distinct()
    placed = stored(_branch_of(turns, branches, stretch), "op1-branches")
    paths = _paths(branches, placed)
    ordered = placed.join(paths, ["conv", "start"], "left").join(branches.withColumnRenamed("start", "turn"), ["conv", "turn"], "left")
    path = F.concat(F.coalesce("path", F.array().cast("array<long>")), F.array("turn"))
    ordered = ordered.select("conv", "turn", F.col("source").alias("parent"), path.alias("path"))
    quotes = links.groupBy(*PLACE).agg(F.count(F.lit(1)).alias("linked"))
    full = mixed.join(ordered, ["conv", "turn"]).join(quotes, PLACE, "left").withColumn("linked", F.coalesce("linked", F.lit(0).cast("long")))
    bare = plain.withColumns({"parent": F.lit(None).cast("long"), "path": F.array("turn"), "linked": F.lit(0).cast("long")})
    columns = ["conv", "turn", "role", "text", "parent", "path", "linked"]
    every = full.select(columns).unionByName(bare.select(columns))
    back = lambda c: F.when(F.col(c) != NO_ID, F.col(c))
    out = every.select(
        back("conv").alias("conv_id"),
        back("turn").alias("turn"),
        "role",
        body_of(F.col("text")).alias("body"),
        "linked",
        back("parent").alias("parent_turn"),
        F.col("path").alias("reply_path"),
    )
    return Linked(out, links)


def _links(mixed: DataFrame, stretch: int) -> DataFrame:
    mixed = mixed.select(*PLACE, "text").distinct()
    lines = mixed.select(*PLACE, F.posexplode(lines_of(F.col("text"))).alias("pos", "line"))
    quoted = lines.select(*PLACE, "pos", level_of(F.col("line")).alias("level"), content_of(F.col("line")).alias("said")).where("level > 0")
    # Consecutive lines of one level: their place less their number is the same.
    island = F.col("pos") - F.row_number().over(Window.partitionBy(*PLACE, "level").orderBy("pos"))
    passages = (
        quoted.withColumn("island", island)
        .groupBy(*PLACE, "level", "island")
        .agg(F.min("pos").alias("start"), F.array_sort(F.collect_list(F.struct("pos", "said"))).alias("lines"))
        .select(*PLACE, "level", "start", F.col("lines.said").alias("lines"))
    )
    passages = passages.withColumn("whole", normal(F.concat_ws(" ", "lines"))).where("whole != ''")
    passages = stored(passages, "op1-passages")

    own = mixed.select("conv", F.col("turn").alias("source"), own_lines(lines_of(F.col("text"))).alias("own"))
    unit = lambda kind, text: F.struct(F.lit(kind).alias("kind"), normal(text).alias("said"))
    paragraphs = F.transform(F.split(F.array_join("own", "\n"), "\n(?:[ \t]*\n)+"), lambda x: unit(1, x))
    every = F.concat(F.array(unit(0, F.array_join("own", " "))), paragraphs, F.transform("own", lambda x: unit(2, x)))
    units = own.select("conv", "source", F.explode(F.array_distinct(every)).alias("u")).where("u.said != ''")
    units = units.select("conv", "source", "u.kind", F.xxhash64("u.said").alias("hash"), F.length("u.said").alias("length"))
    units = stored(units.distinct(), "op1-units")

    one = [*PLACE, "level", "start"]
    asked = passages.select(*one, F.xxhash64("whole").alias("hash"), F.length("whole").alias("length"))
    whole = stored(_last_before(asked, units, one, stretch), "op1-whole")
    parts = passages.join(whole, one, "left_anti").select(*one, F.posexplode("lines").alias("k", "line")).withColumn("said", normal(F.col("line"))).where("said != ''")
    parts = parts.select(*one, "k", F.xxhash64("said").alias("hash"), F.length("said").alias("length"))
    before = F.col("source") < F.col("turn")
    counted = parts.join(units.where("kind = 2"), ["conv", "hash", "length"]).where(before).groupBy(*one, "source").agg(F.count(F.lit(1)).alias("lines"))
    some = counted.groupBy(*one).agg(F.max(F.struct("lines", "source")).alias("best")).select(*one, F.col("best.source").alias("source"))
    return whole.unionByName(some)


def _last_before(asked: DataFrame, units: DataFrame, one: list[str], stretch: int) -> DataFrame:
    """The columns `one` of each passage and its source: of the messages of a smaller turn with its hash, those of the smallest kind, the last of them."""
    key, kinds = ["conv", "hash", "length"], ["s0", "s1", "s2"]
    # Of one turn, passages come first: they do not see messages of their own turn.
    quotes = asked.select(*key, F.col("turn").alias("at"), F.lit(0).alias("is_source"), F.struct(*one).alias("passage"), *[F.lit(None).cast("long").alias(s) for s in kinds])
    sources = units.groupBy(*key, "source").agg(*[F.max(F.when(F.col("kind") == k, F.col("source"))).alias(s) for k, s in enumerate(kinds)])
    sources = sources.select(*key, F.col("source").alias("at"), F.lit(1).alias("is_source"), F.lit(None).cast(quotes.schema["passage"].dataType).alias("passage"), *kinds)
    rows = quotes.unionByName(sources).withColumn("part", F.floor(F.col("at") / stretch))
    up_to = Window.partitionBy(*key, "part").orderBy("at", "is_source").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    inside = rows.select(*key, "part", "passage", *[F.max(s).over(up_to).alias(s) for s in kinds]).where(F.col("passage").isNotNull())
    parts = sources.withColumn("part", F.floor(F.col("at") / stretch)).groupBy(*key, "part").agg(*[F.max(s).alias(s) for s in kinds])
    parts = parts.unionByName(inside.select(*key, "part").distinct(), allowMissingColumns=True).groupBy(*key, "part").agg(*[F.max(s).alias(s) for s in kinds])
    earlier = Window.partitionBy(*key).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    carried = parts.select(*key, "part", *[F.max(s).over(earlier).alias(f"before_{s}") for s in kinds])
    found = inside.join(carried, [*key, "part"])
    source = F.coalesce(*[F.coalesce(s, f"before_{s}") for s in kinds])
    return found.select("passage.*", source.alias("source")).where(F.col("source").isNotNull()).select(*one, "source")


def _branch_of(turns: DataFrame, branches: DataFrame, stretch: int) -> DataFrame:
    """conv, turn, start: the largest first turn of a branch up to each turn; null before any."""
    rows = turns.join(branches.select("conv", F.col("start").alias("turn"), F.col("start").alias("begun")), ["conv", "turn"], "left")
    rows = rows.withColumn("part", F.floor(F.col("turn") / stretch))
    inside = F.max("begun").over(Window.partitionBy("conv", "part").orderBy("turn"))
    totals = rows.groupBy("conv", "part").agg(F.max("begun").alias("most"))
    carried = F.max("most").over(Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    totals = totals.select("conv", "part", carried.alias("carried"))
    return rows.withColumn("inside", inside).join(totals, ["conv", "part"]).select("conv", "turn", F.coalesce("inside", "carried").alias("start"))


def _paths(branches: DataFrame, placed: DataFrame) -> DataFrame:
    """conv, start, path of each branch. Each round joins a path to that of the branch it has come to: log2(depth) rounds."""
    above = placed.select("conv", F.col("turn").alias("source"), F.col("start").alias("up"))
    paths = branches.join(above, ["conv", "source"], "left").select("conv", "start", "up", F.array("source", "start").alias("path"))
    paths = stored(paths, "op1-paths")
    while not paths.where("up IS NOT NULL").isEmpty():
        upper = paths.select("conv", F.col("start").alias("up"), F.col("up").alias("next"), F.col("path").alias("before"))
        joined = paths.join(upper, ["conv", "up"], "left")
        before = F.coalesce("before", F.array().cast("array<long>"))
        paths = stored(joined.select("conv", "start", F.col("next").alias("up"), F.concat(before, "path").alias("path")), "op1-paths")
    return paths.select("conv", "start", "path")


def op1_quotation(spark, sf_dir) -> DataFrame:
    out = link_quotations(table(spark, sf_dir, "conversations")).messages
    return out.withColumn("reply_path", F.array_join(F.transform("reply_path", lambda x: x.cast("string")), "/"))


SQL = {
    "op1_quotation": r"""
WITH RECURSIVE msg AS (SELECT conv_id, turn, role, text, row_number() OVER () AS mid, replace(coalesce(text, ''), chr(13), '') AS t FROM conversations),
line AS (SELECT conv_id, turn, mid, unnest(string_split(t, chr(10))) AS line, generate_subscripts(string_split(t, chr(10)), 1) AS pos FROM msg),
marked AS (SELECT *, regexp_extract(line, '^(?:[ \t]*>)+') AS marks FROM line),
levelled AS (SELECT *, length(marks) - length(replace(marks, '>', '')) AS level, regexp_replace(line, '^(?:[ \t]*>)+[ \t]?', '') AS said FROM marked),
own AS (SELECT conv_id, turn, mid, pos, line, row_number() OVER (PARTITION BY mid ORDER BY pos) AS k FROM (SELECT *, lead(level) OVER (PARTITION BY mid ORDER BY pos) AS next FROM levelled)
  WHERE level = 0 AND NOT (regexp_matches(line, '(?:wrote|schrieb|écrit|escribió):[ \t]*$') AND coalesce(next > 0, false))),
passage AS (SELECT conv_id, turn, mid, level, min(pos) AS start, string_agg(said, ' ' ORDER BY pos) AS whole, list(said ORDER BY pos) AS lines
  FROM (SELECT *, pos - row_number() OVER (PARTITION BY mid, level ORDER BY pos) AS island FROM levelled WHERE level > 0) GROUP BY conv_id, turn, mid, level, island),
asked AS (SELECT *, trim(regexp_replace(translate(whole, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x09-\x0D\x20]+', ' ', 'g')) AS norm FROM passage),
blocks AS (SELECT conv_id, turn, mid, unnest(regexp_split_to_array(string_agg(line, chr(10) ORDER BY pos), '\n(?:[ \t]*\n)+')) AS said FROM own GROUP BY conv_id, turn, mid),
raw AS (SELECT conv_id, turn, 0 AS kind, string_agg(line, ' ' ORDER BY pos) AS said FROM own GROUP BY conv_id, turn, mid
  UNION ALL SELECT conv_id, turn, 1, said FROM blocks UNION ALL SELECT conv_id, turn, 2, line FROM own),
unit AS (SELECT DISTINCT conv_id, turn AS source, kind, trim(regexp_replace(translate(said, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x09-\x0D\x20]+', ' ', 'g')) AS norm FROM raw),
whole AS (SELECT a.conv_id, a.turn, a.mid, a.level, a.start, first(u.source ORDER BY u.kind, u.source DESC) AS source FROM asked a JOIN unit u ON u.conv_id = a.conv_id AND u.norm = a.norm AND u.source < a.turn
  WHERE a.norm <> '' GROUP BY a.conv_id, a.turn, a.mid, a.level, a.start),
single AS (SELECT conv_id, turn, mid, level, start, unnest(lines) AS said FROM asked ANTI JOIN whole USING (mid, level, start) WHERE norm <> ''),
piece AS (SELECT *, trim(regexp_replace(translate(said, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x09-\x0D\x20]+', ' ', 'g')) AS norm FROM single),
counted AS (SELECT p.conv_id, p.turn, p.mid, p.level, p.start, u.source, count(*) AS n FROM piece p JOIN unit u ON u.kind = 2 AND u.conv_id = p.conv_id AND u.norm = p.norm AND u.source < p.turn WHERE p.norm <> ''
  GROUP BY p.conv_id, p.turn, p.mid, p.level, p.start, u.source),
links AS (SELECT * FROM whole UNION ALL SELECT conv_id, turn, mid, level, start, first(source ORDER BY n DESC, source DESC) FROM counted GROUP BY conv_id, turn, mid, level, start),
branch AS (SELECT conv_id, turn AS start, first(source ORDER BY level, start, source) AS source FROM links GROUP BY conv_id, turn),
placed AS (SELECT m.conv_id, m.turn, max(b.start) AS start FROM (SELECT DISTINCT conv_id, turn FROM msg) m LEFT JOIN branch b ON b.conv_id = m.conv_id AND b.start <= m.turn GROUP BY m.conv_id, m.turn),
path AS (SELECT b.conv_id, b.start, p.start AS up, concat(CAST(b.source AS VARCHAR), '/', CAST(b.start AS VARCHAR)) AS path FROM branch b LEFT JOIN placed p ON p.conv_id = b.conv_id AND p.turn = b.source
  UNION ALL SELECT path.conv_id, path.start, p.start, concat(CAST(b.source AS VARCHAR), '/', CAST(b.start AS VARCHAR), '/', path.path) FROM path JOIN branch b ON b.conv_id = path.conv_id AND b.start = path.up LEFT JOIN placed p ON p.conv_id = b.conv_id AND p.turn = b.source),
body AS (SELECT mid, string_agg(line, chr(10) ORDER BY pos) AS body FROM own GROUP BY mid)
SELECT m.conv_id, m.turn, m.role, CASE WHEN NOT contains(m.t, '>') THEN m.t ELSE coalesce(regexp_replace(body.body, '^(?:[ \t]*\n)+|(?:\n[ \t]*)+$', '', 'g'), '') END AS body,
  coalesce(q.n, 0) AS linked, b.source AS parent_turn, concat(CASE WHEN path.path IS NULL THEN '' ELSE concat(path.path, '/') END, CAST(m.turn AS VARCHAR)) AS reply_path
FROM msg m LEFT JOIN body ON body.mid = m.mid LEFT JOIN (SELECT mid, count(*) AS n FROM links GROUP BY mid) q ON q.mid = m.mid
  LEFT JOIN branch b ON b.conv_id = m.conv_id AND b.start = m.turn LEFT JOIN placed p ON p.conv_id = m.conv_id AND p.turn = m.turn
  LEFT JOIN path ON path.conv_id = m.conv_id AND path.start = p.start AND path.up IS NULL
"""
}
QUERIES = {"op1_quotation": op1_quotation}
