"""Target-distribution importance resampling: documents are drawn by how much more their n-grams belong to a target than to the corpus.

1. Each task counts the n-grams of all its texts in one array of `buckets` cells (crc32 of the n-gram modulo `buckets`) and gives the cells
   that are not 0; summed over tasks they are the corpus counts. The same is done with the target's texts.
2. A bucket's gain is a whole number, from both counts. The array of gains has a fixed size; with it in hand, a second pass adds up the
   gains of each document's n-grams (its weight) and adds noise that follows from seed and id, so that the highest scores are a sample.
3. The highest scores are found by parallel sorting by regular sampling: tasks sort their rows and name each `step`-th one (a regular
   sample, at most SAMPLES rows in all); equally spaced samples are the splitters; each task counts its rows between splitters; the sums
   of these counts, added up, say at which rank a segment begins. Segments that begin beyond the number to draw need no exchange. The
   others are exchanged, each is sorted from the runs it received, and a row's rank is its segment's first rank plus its place.
   Rows are told apart by (score, id, row number), so rows that tie, a third of all perhaps, are split like others.

Memory: an array of `buckets` numbers and a slice of texts in a task; SAMPLES rows and the segments' counts on the driver.

Defined cases: null and empty texts have no n-grams and weight 0; a null id is smaller than all others and counts as "null" in the noise;
repeated rows are drawn one by one and ranks stay unique; with an empty target every count of it is 0; an empty documents table gives an empty
result.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallymart.llm import scan
from tallymart.llm.shared import KEY, NO_ID, id_back, keyed, ship, stored, table

#: Regular samples of all runs together, and rows of a segment.
SAMPLES, SEGMENT = 100_000, 20_000

#: Bytes of a word once A-Z are lower-cased: digits, letters, all beyond ASCII.
WORD = np.zeros(256, bool)
WORD[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


def _crc_table() -> np.ndarray:
    """Of the reflected polynomial 0xEDB88320."""
    x = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        x = np.where(x & np.uint32(1), (x >> np.uint32(1)) ^ np.uint32(0xEDB88320), x >> np.uint32(1))
    return x


CRC = _crc_table()


def advance(state: np.ndarray, buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """CRC states after the bytes [start, end), all strings a byte at a time."""
    state, at, left = state.copy(), start.copy(), np.arange(len(start))
    left = left[at < end]
    while len(left):
        s = state[left]
        state[left] = CRC[(s ^ buf[at[left]]) & np.uint32(0xFF)] ^ (s >> np.uint32(8))
        at[left] += 1
        left = left[at[left] < end[left]]
    return state


def ngram_buckets(texts: scan.Texts, longest: int, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(words of each document; document, bucket of every n-gram of 1 to `longest` words, repeats included)."""
    lower = scan.Texts(scan.LOWER[texts.buf], texts.off)
    words = scan.Words(lower, ~WORD)
    counts = words.counts()
    doc = np.repeat(np.arange(len(counts)), counts)
    first = np.arange(len(doc))  # the word an n-gram begins with
    state = np.full(len(doc), 0xFFFFFFFF, np.uint32)
    docs, found = [], []
    for n in range(longest):
        if n:
            on = first + n < words.first[doc[first] + 1]
            first, state = first[on], state[on]
            state = CRC[(state ^ np.uint32(0x20)) & np.uint32(0xFF)] ^ (state >> np.uint32(8))
        state = advance(state, lower.buf, words.start[first + n], words.end[first + n])
        docs.append(doc[first])
        found.append(((state ^ np.uint32(0xFFFFFFFF)) % np.uint32(buckets)).astype(np.int64))
    return counts, np.concatenate(docs), np.concatenate(found)


COUNTS = pa.schema([("bucket", pa.int32()), ("times", pa.int64())])


def _counts(longest: int, buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for b in batches:
            for _, _, texts in scan.slices(b.column("text")):
                total += np.bincount(ngram_buckets(texts, longest, buckets)[2], minlength=buckets)
        at = np.flatnonzero(total)
        yield scan.batch(COUNTS, at.astype(np.int32), total[at])

    return run


def bucket_counts(docs: DataFrame, longest: int = 3, buckets: int = 10_000) -> np.ndarray:
    """How many n-grams of all texts fall in each bucket."""
    ship(docs.sparkSession)
    rows = docs.select("text").mapInArrow(_counts(longest, buckets), "bucket int, times long").groupBy("bucket").agg(F.sum("times").alias("times"))
    out = np.zeros(buckets, np.int64)
    for r in rows.collect():  # at most `buckets` rows
        out[r.bucket] = r.times
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of the smoothed shares of each bucket."""
    s, t, n = float(corpus.sum()), float(target.sum()), float(len(corpus))
    return np.array([math.floor(1000 * math.log(((b + 1.0) * (s + n)) / ((a + 1.0) * (t + n)))) for a, b in zip(corpus.tolist(), target.tolist(), strict=True)], np.int64)


def noise(seed: int, key: int) -> int:
    said = "null" if key == NO_ID else str(key)
    h = int(hashlib.sha256(f"{seed}:{said}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


SCORED = pa.schema([(KEY, pa.int64()), ("n_words", pa.int64()), ("n_features", pa.int64()), ("weight", pa.int64()), ("score", pa.int64())])
SCORED_SQL = f"{KEY} long, n_words long, n_features long, weight long, score long"


def _scores(gain: np.ndarray, longest: int, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys = b.column(KEY).to_numpy()
            for i, j, texts in scan.slices(b.column("text")):
                n_words, doc, bucket = ngram_buckets(texts, longest, len(gain))
                weight = np.zeros(j - i, np.int64)
                np.add.at(weight, doc, gain[bucket])
                luck = np.array([noise(seed, k) for k in keys[i:j].tolist()], np.int64)
                yield scan.batch(SCORED, keys[i:j], n_words.astype(np.int64), np.bincount(doc, minlength=j - i), weight, weight + luck)

    return run


def scored(docs: DataFrame, target: DataFrame, longest: int = 3, buckets: int = 10_000, seed: int = 42) -> DataFrame:
    """Row key, n_words, n_features, weight and score of every row of docs."""
    gain = gains(bucket_counts(docs, longest, buckets), bucket_counts(target, longest, buckets))
    return keyed(docs).select(KEY, "text").mapInArrow(_scores(gain, longest, seed), SCORED_SQL)


def _segments(splitters: np.ndarray, schema: pa.Schema):
    """Segment of each row: the number of splitters not behind it, in the order of (falling score, id, row number)."""
    cut = [np.ascontiguousarray(c) for c in splitters.T]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            own = [-b.column("score").to_numpy(), b.column(KEY).to_numpy(), b.column("row").to_numpy()]
            both = [np.concatenate(x) for x in zip(cut, own, strict=True)]
            order = np.lexsort(both[::-1])
            before = np.cumsum(order < len(cut[0]))
            segment = np.empty(len(order), np.int32)
            segment[order] = before
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(segment[len(cut[0]) :])], schema=schema)

    return run


def highest(rows: DataFrame, draw: int, eligible: int) -> DataFrame:
    """rows (a stored table with a column `row` that numbers them) with `rank`: 1, 2, ... for the `draw` highest scores of those with `ranked`, ties to the
    smaller id; null for all others."""
    order = [F.col("score").desc(), F.col(KEY), F.col("row")]
    step = max(1, -(-eligible // SAMPLES))
    # Locally sorted runs; a row's place in its run is the lower part of the generated id.
    runs = rows.where("ranked").select("score", KEY, "row").sortWithinPartitions(*order)
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    samples = runs.select("*", place.alias("place")).where(F.col("place") % step == step - 1).select((-F.col("score")).alias("score"), KEY, "row")
    samples = np.array([tuple(r) for r in samples.collect()], np.int64).reshape(-1, 3)  # at most SAMPLES rows
    samples = samples[np.lexsort((samples[:, 2], samples[:, 1], samples[:, 0]))]
    segments = min(len(samples) + 1, max(1, -(-eligible // SEGMENT)))
    splitters = samples[[len(samples) * k // segments for k in range(1, segments)]]

    fields = "n_words n_features weight score".split()
    schema = pa.schema([(KEY, pa.int64()), *[(f, pa.int64()) for f in fields], ("row", pa.int64()), ("ranked", pa.bool_()), ("segment", pa.int32())])
    sql = f"{KEY} long, {', '.join(f'{f} long' for f in fields)}, row long, ranked boolean, segment int"
    dealt = rows.select(KEY, *fields, "row", "ranked").mapInArrow(_segments(splitters, schema), sql)
    sizes = dict(tuple(r) for r in dealt.where("ranked").groupBy("segment").count().collect())  # a number for each segment
    starts, total = [], 0
    for k in range(segments):
        starts.append(total)
        total += sizes.get(k, 0)
    last = sum(s < draw for s in starts)  # segments that hold a drawn row

    asked = F.col("ranked") & (F.col("segment") < last)
    own = F.row_number().over(Window.partitionBy("segment").orderBy(*order))
    begin = F.get(F.array(*[F.lit(s).cast("long") for s in starts[:last]]), F.col("segment")) if last else F.lit(None).cast("long")
    ranked = dealt.where(asked).select(KEY, *fields, (begin + own).alias("rank"))
    ranked = ranked.withColumn("rank", F.when(F.col("rank") <= draw, F.col("rank")))
    return ranked.unionByName(dealt.where(~asked).select(KEY, *fields, F.lit(None).cast("long").alias("rank")))


def resampled(docs: DataFrame, target: DataFrame, percent: int = 5, least_words: int = 20, longest: int = 3, buckets: int = 10_000, seed: int = 42) -> DataFrame:
    """Row key, n_words, n_features, weight, score and rank of every row of docs; drawn are `percent` of those with `least_words` words."""
    rows = scored(docs, target, longest, buckets, seed).withColumn("ranked", F.col("n_words") >= least_words)
    rows = stored(rows.withColumn("row", F.monotonically_increasing_id()), "op12-scored")
    eligible = rows.where("ranked").count()
    return highest(rows, percent * eligible // 100, eligible)


def op12_resampling(spark, sf_dir) -> DataFrame:
    out = resampled(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return out.select(id_back(), "n_features", "weight", "score", "rank")


#: crc32 is linear: the effect of a byte that stands d bytes before the end is a table of (d, byte), and effects are joined by xor.
SQL = {
    "op12_resampling": r"""
WITH RECURSIVE t0 AS (SELECT b, list_reduce(list_prepend(CAST(b AS UBIGINT), [CAST(0 AS UBIGINT) FOR i IN range(8)]), lambda x, y: CASE WHEN x % 2 = 1 THEN xor(x >> 1, CAST(3988292384 AS UBIGINT)) ELSE x >> 1 END) AS v FROM range(256) r(b)),
said AS (SELECT 'd' AS kind, doc_id AS id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
  UNION ALL SELECT 'b', item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') FROM benchmark),
grams AS (SELECT kind, id, array_to_string(w[i:i + n - 1], ' ') AS f FROM (SELECT kind, id, w, n, unnest(range(1, CAST(len(w) - n + 2 AS BIGINT))) AS i FROM said, range(1, 4) g(n) WHERE len(w) >= n)),
distinct_grams AS (SELECT f, octet_length(encode(f)) AS n FROM (SELECT DISTINCT f FROM grams)),
most AS (SELECT max(n) AS n FROM distinct_grams),
tables AS (SELECT CAST(0 AS BIGINT) AS d, b, v FROM t0 UNION ALL SELECT d + 1, tables.b, xor(tables.v >> 8, t0.v) FROM tables JOIN t0 ON t0.b = CAST(tables.v % 256 AS BIGINT), most WHERE d < most.n),
starts AS (SELECT CAST(0 AS BIGINT) AS n, CAST(4294967295 AS UBIGINT) AS v UNION ALL SELECT starts.n + 1, xor(starts.v >> 8, t0.v) FROM starts JOIN t0 ON t0.b = CAST(starts.v % 256 AS BIGINT), most WHERE starts.n < most.n),
bytes AS (SELECT f, n, n - 1 - i AS d, CAST(('0x' || substr(hex(encode(f)), CAST(2 * i + 1 AS BIGINT), 2)) AS BIGINT) AS b FROM (SELECT f, n, unnest(range(0, CAST(n AS BIGINT))) AS i FROM distinct_grams)),
crc AS (SELECT f, xor(xor(any_value(starts.v), bit_xor(tables.v)), CAST(4294967295 AS UBIGINT)) % 10000 AS bucket FROM bytes JOIN tables USING (d, b) JOIN starts ON starts.n = bytes.n GROUP BY f),
placed AS (SELECT kind, id, bucket FROM grams JOIN crc USING (f)),
cells AS (SELECT bucket, CAST(count(*) FILTER (WHERE kind = 'd') AS DOUBLE) AS s, CAST(count(*) FILTER (WHERE kind = 'b') AS DOUBLE) AS t FROM placed GROUP BY bucket),
totals AS (SELECT sum(s) AS s, sum(t) AS t FROM cells),
gain AS (SELECT bucket, CAST(floor(1000 * ln(((cells.t + 1) * (totals.s + 10000)) / ((cells.s + 1) * (totals.t + 10000)))) AS BIGINT) AS g FROM cells, totals),
weights AS (SELECT id AS doc_id, count(*) AS n_features, CAST(sum(g) AS BIGINT) AS weight FROM placed JOIN gain USING (bucket) WHERE kind = 'd' GROUP BY id),
scores AS (SELECT id AS doc_id, len(w) >= 20 AS able, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
  coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((CAST(('0x' || substr(sha256('42:' || id), 1, 8)) AS BIGINT) + 0.5) / CAST(4294967296 AS DOUBLE)))) AS BIGINT) AS score FROM said LEFT JOIN weights ON weights.doc_id = said.id WHERE kind = 'd'),
ordered AS (SELECT *, CASE WHEN able THEN row_number() OVER (PARTITION BY able ORDER BY score DESC, doc_id) END AS place, count(*) FILTER (WHERE able) OVER () AS n FROM scores)
SELECT doc_id, n_features, weight, score, CASE WHEN place <= 5 * n // 100 THEN place END AS rank FROM ordered
"""
}
QUERIES = {"op12_resampling": op12_resampling}
