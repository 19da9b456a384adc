"""Benchmark decontamination as a prefix-filtered set join, in DataFrame functions only.

A window is `window` consecutive words of a benchmark item, and a document is contaminated by what it holds of whole windows.
1. Words of a text are cut once. Every `shingle` consecutive words make a token; a document's tokens that some window has too are
   its hits and are stored with their place, together with one row for each document.
2. The hits give every token's frequency over all documents. Tokens are ordered by rarity; as a window must be held whole, its one
   rarest token is its necessary prefix. A window with a token that no document has is out.
3. Hits of prefix tokens give candidates (document, start). Length and positional bounds drop those that would begin before or end
   behind the document.
4. Candidates are verified word by word against the stored hits.

Defined cases: null and empty texts have no word, are never hit and make no window; items of fewer words than a window are one
window; a document id given twice gives one result per row; equal item ids count once, a null item id counts as "null"; with an empty
benchmark no document is hit; an empty documents table gives an empty result.
"""

from __future__ import annotations

import string
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymart.llm.shared import KEY, PRINT, id_back, keyed, narrow, row_key, small_enough, stored

#: Fixed value: characters of a word, after A-Z are lower-cased.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Up to so many rows the benchmark's tables are broadcast (some 64 bytes a row); beyond it the same joins shuffle.
BROADCAST_ROWS = 500_000


@dataclass(frozen=True)
class Contamination:
    """documents: one row per document with its verdict; spans: every occurrence of a window as (doc id, start, length, item_id)."""

    documents: DataFrame
    spans: DataFrame


def lowered(text: Column) -> Column:
    """A-Z lower-cased, nothing else. lower() does just that to pure ASCII, and faster."""
    ascii_only = F.length(text) == F.octet_length(text)
    return F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, string.ascii_uppercase, string.ascii_lowercase))


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(lowered(F.coalesce(text, F.lit(""))), F.lit(WORD), F.lit(0))


def token(words: Column, at: Column, size: int) -> Column:
    return F.xxhash64(*[F.get(words, at + i) for i in range(size)])


def windows_of(benchmark: DataFrame, window: int, shingle: int) -> DataFrame:
    """Distinct windows: wid, words, size of a token, and the items that have them."""
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("null")).alias("item"), words_of(F.col("text")).alias("all"))
    items = items.where(F.size("all") > 0).withColumn("length", F.least(F.size("all"), F.lit(window)))
    starts = F.explode(F.sequence(F.lit(1), F.size("all") - F.col("length") + 1))
    each = items.select("item", "all", "length", starts.alias("from")).select("item", F.slice("all", F.col("from"), F.col("length")).alias("words"))
    wid = F.xxhash64(F.concat_ws(" ", "words"))
    return each.select(wid.alias("wid"), "words", F.least(F.size("words"), F.lit(shingle)).alias("gram"), "item").distinct()


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = 13, shingle: int = 3, percent: int = 5) -> Contamination:
    """A document is contaminated if it has hit words and they are at least `percent` per cent of its words."""
    found = windows_of(benchmark, window, shingle)
    owners = stored(found.select("wid", "item"), "op7-owners")
    windows = stored(found.drop("item").distinct(), "op7-windows")
    sizes = sorted(r.gram for r in windows.select("gram").distinct().collect())  # at most `shingle` numbers

    # The tokens of every window; j is the token's place in it.
    tokens = windows.select("wid", "gram", F.size("words").alias("length"), "words", F.explode(F.sequence(F.lit(0), F.size("words") - F.col("gram"))).alias("j"))
    tokens = tokens.select("wid", "gram", "length", "j", _by_size(sizes, F.col("words"), F.col("j"), F.col("gram")).alias("token"), F.slice("words", F.col("j") + 1, F.col("gram")).alias("said"))
    tokens = stored(tokens, "op7-tokens")

    hits = stored(_hits(docs, tokens, sizes, shingle), "op7-hits")
    seen = hits.where(F.col("token").isNotNull())

    # Rarity over all documents, and the rarest token of each window that can occur at all.
    often = seen.groupBy("token").agg(F.count(F.lit(1)).alias("often"))
    rarest = (
        tokens.join(narrow(often, BROADCAST_ROWS), "token", "left")
        .groupBy("wid", "gram", "length")
        .agg(F.min(F.struct("often", "token", "j")).alias("p"), F.count_if(F.col("often").isNull()).alias("absent"))
        .where(F.col("absent") == 0)
        .select("wid", "gram", "length", F.col("p.token").alias("token"), F.col("p.j").alias("j"))
    )
    prefix = stored(rarest, "op7-prefix")
    start = F.col("pos") - F.col("j")
    candidates = (
        seen.join(narrow(prefix, BROADCAST_ROWS), "token")
        .where((start >= 0) & (start + F.col("length") <= F.col("n_words")))
        .select(KEY, PRINT, "wid", "length", "gram", start.alias("start"))
        .distinct()
    )

    # Tokens at every gram-th place and the last one cover all words of a window.
    last = F.col("length") - F.col("gram")
    proof = tokens.where((F.col("j") % F.col("gram") == 0) | (F.col("j") == last)).select("wid", "j", "said")
    needed = F.floor(last / F.col("gram")) + 1 + F.when(last % F.col("gram") > 0, 1).otherwise(0)
    asked = candidates.join(narrow(proof, BROADCAST_ROWS), "wid").withColumn("pos", F.col("start") + F.col("j"))
    spans = (
        asked.join(seen.select(KEY, PRINT, "pos", "said").distinct(), [KEY, PRINT, "pos", "said"])
        .groupBy(KEY, PRINT, "wid", "start", "length", "gram")
        .agg(F.count(F.lit(1)).alias("proved"))
        .where(F.col("proved") == needed)
        .select(KEY, PRINT, "wid", "start", "length")
    )
    spans = stored(spans, "op7-spans")

    # Words covered, and items concerned; both bounded by the length of one document.
    covered = F.array_distinct(F.flatten(F.transform("at", lambda s: F.sequence(s["start"], s["start"] + s["length"] - 1))))
    hit = spans.groupBy(KEY, PRINT).agg(F.collect_set(F.struct("start", "length")).alias("at")).select(KEY, PRINT, F.size(covered).cast("long").alias("n_hit"))
    concerned = spans.select(KEY, PRINT, "wid").distinct().join(narrow(owners, BROADCAST_ROWS), "wid")
    items = concerned.groupBy(KEY, PRINT).agg(F.array_sort(F.collect_set("item")).alias("items"))
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    documents = (
        hits.where("head")
        .select(KEY, PRINT, "n_words")
        .join(hit.join(items, [KEY, PRINT]), [KEY, PRINT], "left")
        .select(
            id_back(),
            F.col(PRINT),
            F.col(KEY),
            F.col("n_words").cast("long").alias("n_words"),
            n_hit.alias("n_hit"),
            F.coalesce("items", F.array().cast("array<string>")).alias("items"),
            ((n_hit > 0) & (n_hit * 100 >= F.col("n_words") * percent)).alias("contaminated"),
        )
    )
    return Contamination(documents, spans.join(narrow(owners, BROADCAST_ROWS), "wid").select(id_back(), F.col(PRINT), "start", "length", F.col("item").alias("item_id")))


def _by_size(sizes: list[int], words: Column, at: Column, size: Column) -> Column:
    out = F.lit(None).cast("long")
    for s in sizes:
        out = F.when(size == s, token(words, at, s)).otherwise(out)
    return out


def _hits(docs: DataFrame, tokens: DataFrame, sizes: list[int], shingle: int) -> DataFrame:
    """Every place of a document where a token of some window stands, and a head row for each document."""
    cut = keyed(docs).select(KEY, PRINT, words_of(F.col("text")).alias("words"))
    each = cut.select(KEY, PRINT, "words", F.posexplode_outer("words").alias("pos", "word"))
    if len(sizes) > 1:
        each = each.select("*", F.explode(F.array(*map(F.lit, sizes))).alias("gram"))
    else:
        each = each.withColumn("gram", F.lit(sizes[0] if sizes else shingle))
    fits = F.col("pos") + F.col("gram") <= F.size("words")
    each = each.withColumn("token", F.when(fits, _by_size(sizes, F.col("words"), F.col("pos"), F.col("gram"))))
    known = stored(tokens.select(F.col("token").alias("known"), F.col("gram").alias("known_gram")).distinct(), "op7-known")
    same = (F.col("token") == F.col("known")) & (F.col("gram") == F.col("known_gram"))
    if not small_enough(known, BROADCAST_ROWS):
        return _hits_apart(cut, each, known, same)
    joined = each.join(F.broadcast(known), same, "left")
    head = F.coalesce(F.col("pos"), F.lit(0)) == 0
    if len(sizes) > 1:
        head &= F.col("gram") == sizes[0]
    hit = F.col("known").isNotNull()
    return joined.where(head | hit).select(
        KEY,
        PRINT,
        "pos",
        F.size("words").alias("n_words"),
        F.when(hit, F.col("token")).alias("token"),
        F.when(hit, F.slice("words", F.coalesce(F.col("pos"), F.lit(0)) + 1, F.col("gram"))).alias("said"),
        head.alias("head"),
    )


def _hits_apart(cut: DataFrame, each: DataFrame, known: DataFrame, same: Column) -> DataFrame:
    """As _hits, with more tokens than are broadcast: tokens are shuffled without the words around them, which are then taken from each hit document."""
    places = each.where(F.col("token").isNotNull()).select(KEY, PRINT, "pos", "gram", "token").join(known, same)
    found = places.groupBy(KEY, PRINT).agg(F.collect_set(F.struct("pos", "gram", "token")).alias("at"))
    n = F.size("words").alias("n_words")
    hits = cut.join(found, [KEY, PRINT]).select(KEY, PRINT, "words", F.explode("at").alias("at"))
    hits = hits.select(KEY, PRINT, "at.pos", n, "at.token", F.slice("words", F.col("at.pos") + 1, F.col("at.gram")).alias("said"), F.lit(False).alias("head"))
    none = [F.lit(0).alias("pos"), n, F.lit(None).cast("long").alias("token"), F.lit(None).cast("array<string>").alias("said")]
    return hits.unionByName(cut.select(KEY, PRINT, *none, F.lit(True).alias("head")))


def clean_documents(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The rows of docs that are not contaminated, with all their columns."""
    dirty = contamination(docs, benchmark, **options).documents.where("contaminated").select(KEY, PRINT).distinct()
    whole = docs.select(*row_key(), F.struct("*").alias("_row"))
    return whole.join(dirty, [KEY, PRINT], "left_anti").select("_row.*")


def op7_decontaminate(spark, sf_dir) -> DataFrame:
    docs, benchmark = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "benchmark"))
    found = contamination(docs, benchmark).documents
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), "contaminated"
    )


SQL = {
    "op7_decontaminate": r"""
WITH doc AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
item AS (SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
win AS (SELECT item, least(len(w), 13) AS n, unnest(list_transform(range(1, len(w) - least(len(w), 13) + 2), lambda i: array_to_string(w[i:i + least(len(w), 13) - 1], ' '))) AS said FROM item WHERE len(w) > 0),
sizes AS (SELECT DISTINCT n FROM win),
places AS (SELECT doc_id, n, w, unnest(range(1, CAST(len(w) - n + 2 AS BIGINT))) AS i FROM doc, sizes WHERE len(w) >= n),
hit AS (SELECT p.doc_id, p.i, p.n, win.item FROM (SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS said FROM places) p JOIN win ON win.said = p.said AND win.n = p.n),
covered AS (SELECT doc_id, count(DISTINCT place) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS place FROM hit) GROUP BY doc_id),
items AS (SELECT doc_id, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS list FROM hit GROUP BY doc_id)
SELECT doc.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(list, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM doc LEFT JOIN covered USING (doc_id) LEFT JOIN items USING (doc_id)
"""
}
QUERIES = {"op7_decontaminate": op7_decontaminate}
