"""Substring dedup by seed and extend, over words.

Every window of `length` words has a winnowed anchor, the gram of `seed` words with the least hash in it. Documents that share an anchor
are matched around it: the match is extended to the left and to the right as far as the anchor's region reaches, for all of it at once
by its class, and where that differs from other documents', for each window by its hash (see matches.py). Neighbouring regions extend
one another, so that joined windows are the maximal repeats of at least `length` words.

A repeat is removed from every document but the one with the smallest id that holds it; repeats within one document stay.

Defined cases: a null or empty text has no words; a text shorter than a window keeps all; a null id is smaller than all others; rows
that share an id are not compared with one another; white space between kept words becomes one space; an empty table gives an empty
result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymart.llm import scan
from tallymart.llm.matches import Units, covered, repeated_in_smaller, repeated_windows, row_texts, with_found
from tallymart.llm.shared import KEY, PRINT, id_back, table

OUT = pa.schema([(KEY, pa.int64()), (PRINT, pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("spans", pa.list_(pa.list_(pa.int64()))), ("kept", pa.large_string())])
OUT_SQL = f"{KEY} long, {PRINT} long, n_words long, n_removed long, spans array<array<long>>, kept string"


def _units(length: int, seed: int):
    def read(texts: scan.Texts) -> Units:
        words = scan.Words(texts)
        hashes = words.hashes()
        return Units(scan.grams(hashes, seed), scan.grams(hashes, length), words.first, length, seed)

    return read


def spaced(texts: scan.Texts, words: scan.Words, keep: np.ndarray) -> pa.Array:
    """The kept words of each document, joined by one space."""
    start, end = words.start[keep], words.end[keep]
    first = np.searchsorted(start, texts.off)
    size = end - start + 1
    last = first[1:][first[1:] > first[:-1]] - 1
    size[last] -= 1  # no space behind a document's last word
    of, place = scan.within(size)
    out = np.append(texts.buf, np.uint8(0x20))[start[of] + place]
    ends = np.cumsum(size)
    inner = np.ones(len(size), bool)
    inner[last] = False
    out[ends[inner] - 1] = 0x20
    off = np.concatenate([[0], ends])[first].astype(np.int64)
    return pa.LargeStringArray.from_buffers(len(texts), pa.py_buffer(off), pa.py_buffer(np.ascontiguousarray(out)))


def spans_of(gone: np.ndarray, first: np.ndarray) -> pa.Array:
    """For each document its maximal runs of removed units, as [start, end) from its own beginning."""
    start, end = scan.runs(gone, first)
    of = np.searchsorted(first, start, "right") - 1
    count = np.bincount(of, minlength=len(first) - 1)
    flat = np.column_stack([start - first[of], end - first[of]]).ravel().astype(np.int64)
    inner = pa.ListArray.from_arrays(pa.array(np.arange(len(start) + 1) * 2, pa.int32()), pa.array(flat))
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(count)]), pa.int32()), inner)


def _clean(length: int, seed: int, listed: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys, prints = b.column(KEY).to_numpy(), b.column(PRINT).to_numpy()
            for i, j, texts in scan.slices(b.column("text")):
                words = scan.Words(texts)
                gone = np.zeros(len(words.start), bool)
                if listed:
                    _, hit = repeated_windows(_units(length, seed)(texts), b.column("kinds").slice(i, j - i), b.column("windows").slice(i, j - i))
                    gone = covered(hit, length, len(gone))
                total = np.concatenate([[0], np.cumsum(gone)])[words.first]
                yield scan.batch(OUT, keys[i:j], prints[i:j], words.counts(), np.diff(total), spans_of(gone, words.first), spaced(texts, words, ~gone))

    return run


def dedup_substrings(docs: DataFrame, length: int = 50, seed: int = 10) -> DataFrame:
    """Row key, n_words, n_removed, spans (of removed words) and kept text of every row."""
    texts = row_texts(docs)
    found = repeated_in_smaller(texts, _units(length, seed), "op9")
    hit, rest = with_found(texts, found, "op9")
    return hit.mapInArrow(_clean(length, seed, True), OUT_SQL).unionByName(rest.mapInArrow(_clean(length, seed, False), OUT_SQL))


def op9_substring_dedup(spark, sf_dir) -> DataFrame:
    out = dedup_substrings(table(spark, sf_dir, "documents"))
    return out.select(id_back(), "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


SQL = {
    "op9_substring_dedup": r"""
WITH doc AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS (SELECT doc_id, i, md5(array_to_string(w[i:i + 49], ' ')) AS h FROM (SELECT doc_id, w, unnest(range(1, CAST(len(w) - 48 AS BIGINT))) AS i FROM doc WHERE len(w) >= 50)),
least_doc AS (SELECT h, min(doc_id) AS m FROM win GROUP BY h HAVING min(doc_id) < max(doc_id)),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS place FROM win JOIN least_doc USING (h) WHERE m < doc_id),
words AS (SELECT doc_id, unnest(range(1, CAST(len(w) + 1 AS BIGINT))) AS place, unnest(w) AS word FROM doc),
kept AS (SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY place) AS said FROM words ANTI JOIN gone USING (doc_id, place) GROUP BY doc_id)
SELECT doc.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(said, '')) AS kept_sha256
FROM doc LEFT JOIN kept USING (doc_id)
"""
}
QUERIES = {"op9_substring_dedup": op9_substring_dedup}
