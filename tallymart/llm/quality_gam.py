"""Quality classifier: a generalised additive model with pairwise interactions.

Each feature is cut into bins at quantiles. Cyclic boosting goes round the features again and again; each turn fits a shallow tree to the
gradients summed by bin of one feature and adds it, shrunk, to that feature's lookup table. Then the pairs of features whose quadrants
explain most of the rest get lookup tables of two dimensions in the same way. A score is the sigmoid of a sum of table entries, looked
up for whole batches at once.

The model is fitted on the driver to at most `max_rows` labelled rows (those first by a hash of their id); only their features, never
their texts, go there. Everything else, features and scores, is computed where the documents are, without a shuffle.

Defined cases: a null or empty text has all features 0 and gets a score; rows that share an id are scored each; without a labelled
row, or with one class only, the score is the (smoothed) share of label 1; an empty table gives an empty result. Labels without id or
quality are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymart.llm import scan
from tallymart.llm.quality_rules import IS_SYMBOL, Page
from tallymart.llm.shared import KEY, PRINT, id_back, keyed, row_key, table

#: Labels are learned from at most so many rows.
MAX_ROWS = 20_000
BINS, PAIR_BINS, PAIRS = 32, 8, 6
ROUNDS, PAIR_ROUNDS, RATE, LEAST = 150, 60, 0.1, 20.0
THRESHOLD = 0.7

NAMES = [
    "log_words",
    "word_length",
    "word_length_spread",
    "symbols_per_char",
    "symbol_words",
    "capital_words",
    "capital_letters",
    "stutter",
    "repeated_words",
    "duplicate_lines",
    "bars_per_word",
    "exclamations_per_word",
    "closed_lines",
    "log_words_per_line",
    "log_longest_line",
    "digits_per_char",
    "short_words",
    "distinct_words",
    "commas_per_word",
    "stops_per_word",
]


def features(page: Page) -> np.ndarray:
    """One row of numbers for each document of a slice."""
    buf, off = page.texts.buf, page.texts.off
    count = lambda mask: np.diff(np.concatenate([[0], np.cumsum(mask)])[off]).astype(float)
    words = page.words.counts().astype(float)
    chars = page.by_doc(page.chars).astype(float)
    n, c = np.maximum(words, 1), np.maximum(chars, 1)
    length = chars / n
    spread = np.sqrt(np.maximum(page.by_doc(page.chars * page.chars) / n - length**2, 0))
    letters, capitals = page.capitals()
    lines = np.maximum(np.bincount(page.line_doc[page.line_words > 0], minlength=len(off) - 1), 1).astype(float)
    # The last byte of a line's last word.
    some = page.line_words > 0
    last = buf[page.words.end[page.line_word[:-1][some] + page.line_words[some] - 1] - 1]
    closed = np.bincount(page.line_doc[some][np.isin(last, list(b".!?:;\"')"))], minlength=len(off) - 1)
    longest = np.zeros(len(off) - 1)
    np.maximum.at(longest, page.line_doc, page.line_words)
    order = np.lexsort((page.hash, page.doc))
    new = scan.first_of_runs(page.doc[order], page.hash[order]) if len(order) else np.zeros(0, bool)
    distinct = np.bincount(page.doc[order][new], minlength=len(off) - 1)
    columns = [
        np.log1p(words),
        length,
        spread,
        count(IS_SYMBOL[buf]) / c,
        page.by_doc(page.symbols > 0) / n,
        page.by_doc((letters >= 2) & (letters == capitals)) / n,
        page.by_doc(capitals) / np.maximum(page.by_doc(letters), 1),
        page.by_doc(page.stutter()) / n,
        page.by_doc(page.repeated_words()) / n,
        np.bincount(page.line_doc[page.duplicate_lines()], minlength=len(off) - 1) / lines,
        count(buf == ord("|")) / n,
        count(buf == ord("!")) / n,
        closed / lines,
        np.log1p(words / lines),
        np.log1p(longest),
        count((buf >= 0x30) & (buf <= 0x39)) / c,
        page.by_doc(page.chars <= 3) / n,
        distinct / n,
        count(buf == ord(",")) / n,
        count(buf == ord(".")) / n,
    ]
    return np.column_stack(columns)


def _tree(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Leaf values, by bin, of a tree of up to three cuts over ordered bins, grown at the best cut each time."""
    out = np.zeros(len(g))
    G, H = (np.concatenate([[0], np.cumsum(x)]) for x in (g, h))
    leaves = [(0, len(g))]
    for _ in range(3):
        best = (1e-9, None, None)
        for a, b in leaves:
            if b - a < 2:
                continue
            k = np.arange(a + 1, b)
            gl, hl, gr, hr = G[k] - G[a], H[k] - H[a], G[b] - G[k], H[b] - H[k]
            gain = gl**2 / (hl + 1) + gr**2 / (hr + 1) - (G[b] - G[a]) ** 2 / (H[b] - H[a] + 1)
            gain[(hl < 0.02 * LEAST) | (hr < 0.02 * LEAST)] = 0
            at = int(np.argmax(gain))
            if gain[at] > best[0]:
                best = (gain[at], (a, b), int(k[at]))
        if best[1] is None:
            break
        leaves.remove(best[1])
        leaves += [(best[1][0], best[2]), (best[2], best[1][1])]
    for a, b in leaves:
        out[a:b] = (G[b] - G[a]) / (H[b] - H[a] + 1)
    return out


def _quadrants(g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
    """The best tree with one cut in each direction of a grid, and its gain."""
    G, H = (np.pad(x.cumsum(0).cumsum(1), ((1, 0), (1, 0))) for x in (g, h))
    m, n = g.shape
    best, values = 0.0, np.zeros_like(g)
    whole = G[-1, -1] ** 2 / (H[-1, -1] + 1)
    for i in range(1, m):
        for j in range(1, n):
            parts = [
                (slice(0, i), slice(0, j), G[i, j], H[i, j]),
                (slice(0, i), slice(j, n), G[i, n] - G[i, j], H[i, n] - H[i, j]),
                (slice(i, m), slice(0, j), G[m, j] - G[i, j], H[m, j] - H[i, j]),
                (slice(i, m), slice(j, n), G[m, n] - G[i, n] - G[m, j] + G[i, j], H[m, n] - H[i, n] - H[m, j] + H[i, j]),
            ]
            gain = sum(x**2 / (y + 1) for _, _, x, y in parts) - whole
            if gain > best:
                best, values = gain, np.zeros_like(g)
                for a, b, x, y in parts:
                    values[a, b] = x / (y + 1)
    return best, values


@dataclass
class Gam:
    start: float = 0.0
    cuts: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    coarse: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int, np.ndarray]] = field(default_factory=list)

    def score(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.start)
        bins = [np.searchsorted(c, x[:, k], "right") for k, c in enumerate(self.cuts)]
        for k, values in enumerate(self.tables):
            out += values[bins[k]]
        for a, b, values in self.pairs:
            out += values[self.coarse[a][bins[a]], self.coarse[b][bins[b]]]
        return 1 / (1 + np.exp(-out))

    @staticmethod
    def fit(x: np.ndarray, y: np.ndarray) -> Gam:
        share = (y.sum() + 1) / (len(y) + 2)
        model = Gam(float(np.log(share / (1 - share))))
        if len(set(y.tolist())) < 2:
            return model
        n, k = x.shape
        model.cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[1:-1])) for f in range(k)]
        bins = [np.searchsorted(c, x[:, f], "right") for f, c in enumerate(model.cuts)]
        model.tables = [np.zeros(len(c) + 1) for c in model.cuts]
        raw = np.full(n, model.start)

        def slopes(bin_of: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
            p = 1 / (1 + np.exp(-raw))
            return np.bincount(bin_of, y - p, size), np.bincount(bin_of, p * (1 - p), size)

        for _ in range(ROUNDS):
            for f in range(k):
                step = RATE * _tree(*slopes(bins[f], len(model.tables[f])))
                model.tables[f] += step
                raw += step[bins[f]]
        # Pairs on coarser bins: neighbouring bins joined.
        model.coarse = [np.arange(len(t)) * PAIR_BINS // max(len(t), PAIR_BINS) for t in model.tables]
        rough = [model.coarse[f][bins[f]] for f in range(k)]
        grid = (PAIR_BINS, PAIR_BINS)

        def pair_slopes(a: int, b: int) -> list[np.ndarray]:
            return [s.reshape(grid) for s in slopes(rough[a] * PAIR_BINS + rough[b], PAIR_BINS**2)]

        gains = sorted(((_quadrants(*pair_slopes(a, b))[0], a, b) for a in range(k) for b in range(a)), reverse=True)
        model.pairs = [(a, b, np.zeros(grid)) for gain, a, b in gains[:PAIRS] if gain > 0]
        for _ in range(PAIR_ROUNDS):
            for a, b, values in model.pairs:
                step = RATE * _quadrants(*pair_slopes(a, b))[1]
                values += step
                raw += step[rough[a], rough[b]]
        return model


FEATURED = pa.schema([("x", pa.list_(pa.float64()))])
SCORED = pa.schema([(KEY, pa.int64()), (PRINT, pa.int64()), ("score", pa.float64())])


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for i, j, texts in scan.slices(b.column("text")):
            x = features(Page(texts))
            rows = pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), x.shape[1]).cast(pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([b.column("quality").slice(i, j - i), rows], names=["quality", "x"])


def _scores(model: Gam):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys, prints = b.column(KEY).to_numpy(), b.column(PRINT).to_numpy()
            for i, j, texts in scan.slices(b.column("text")):
                yield scan.batch(SCORED, keys[i:j], prints[i:j], model.score(features(Page(texts))))

    return run


def train(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> Gam:
    """A model of labels.quality, from at most max_rows labelled rows: of the rows that share a labelled id, the text with the least print."""
    rows = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull())
    sample = rows.select(F.col("doc_id").cast("long").alias("_id"), F.col("quality").cast("int").alias("quality"))
    sample = sample.orderBy(F.xxhash64("_id"), "_id", "quality").limit(max_rows)
    texts = keyed(docs)
    # One text an id, so that no more rows than those of the sample come back.
    known = texts.join(F.broadcast(sample.select("_id").distinct()), F.col(KEY) == F.col("_id"), "left_semi")
    one = known.groupBy(KEY).agg(F.min(F.struct(PRINT, "text")).alias("first")).select(KEY, "first.text")
    found = one.join(F.broadcast(sample), F.col(KEY) == F.col("_id")).select("quality", "text")
    seen = found.mapInArrow(_features, "quality int, x array<double>").collect()
    if not seen:
        return Gam()
    seen.sort()  # the order of arrival must not matter
    return Gam.fit(np.array([r.x for r in seen]), np.array([r.quality for r in seen], float))


def score(docs: DataFrame, model: Gam) -> DataFrame:
    """Row key and score of every row."""
    return keyed(docs).mapInArrow(_scores(model), f"{KEY} long, {PRINT} long, score double")


def held_out(id_column: str = "doc_id"):
    """Rows whose label is never learned from: the checksum of the id as text is 2 modulo 4."""
    return F.coalesce(F.crc32(F.col(id_column).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def good_documents(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of docs that score at least `threshold`, with all their columns."""
    model = train(docs, labels.where(~held_out()))
    good = score(docs, model).where(F.col("score") >= threshold).select(KEY, PRINT).distinct()
    whole = docs.select(*row_key(), F.struct("*").alias("_row"))
    return whole.join(good, [KEY, PRINT], "left_semi").select("_row.*")


def op2_quality_gam(spark, sf_dir) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = train(docs, labels.where(~held_out()))
    scored = score(docs, model).select(id_back(), "score")
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


SQL = {}
QUERIES = {"op2_quality_gam": op2_quality_gam}
