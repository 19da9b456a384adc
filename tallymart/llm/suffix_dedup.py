"""Repeated byte strings by seeds and regions over bytes. This stands in place of bucket-pointer refinement (as in suffix array construction).

Refinement by rank tables needs a row for each byte that is in a bucket of several members, and moves it in every round; README has what
that would cost. Here a pointer is a hash of the bytes at a position, made where the text is, so that all tasks agree on it without a sort of
positions: that of 2m bytes at x joins those of m bytes at x and at x + m, until it stands for `length` bytes.

The first sort is on a sample that cannot miss a repeat: the position with the least pointer of q = length / 2 bytes of each window. Its seed is split by
the pointers around it (the region it stands for); members equal in them are settled together, and only seeds that still have different
regions are compared at single positions (see matches.py). Within one document the same is done where the text is read.

Every byte in a string of `length` bytes that starts earlier too, in a smaller id or before in the same document, is removed.

Defined cases: a null or empty text has no bytes; a text shorter than `length` keeps all; a null id is smaller than all others; rows
that share an id are not compared with one another; what is kept is bytes, as a removal may cut a character; an empty table gives an
empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymart.llm import scan
from tallymart.llm.matches import Regions, Units, covered, regions_of, repeated_in_smaller, repeated_windows, row_texts, with_found
from tallymart.llm.shared import KEY, PRINT, id_back, table
from tallymart.llm.substring_dedup import spans_of

OUT = pa.schema([(KEY, pa.int64()), (PRINT, pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("spans", pa.list_(pa.list_(pa.int64()))), ("kept", pa.large_binary())])
OUT_SQL = f"{KEY} long, {PRINT} long, n_bytes long, n_removed long, spans array<array<long>>, kept binary"


def refined(pointers: np.ndarray, later: int, count: int) -> np.ndarray:
    """Pointers joined with those `later` positions on."""
    return scan.mix(pointers[:count] + scan.mix(pointers[later : later + count]))


def _units(length: int):
    def read(texts: scan.Texts) -> Units:
        n, q = len(texts.buf), max(1, length // 2)
        at = np.arange(max(0, n - q + 1))
        first = pointers = scan.mix(scan.stretch(scan.byte_sums(texts.buf), at, at + q))
        m = q
        while 2 * m <= length:
            pointers = refined(pointers, m, max(0, n - 2 * m + 1))
            m *= 2
        if m < length:
            pointers = refined(pointers, length - m, max(0, n - length + 1))
        return Units(first, pointers, texts.off, length, q)

    return read


def again_in_document(units: Units, r: Regions) -> np.ndarray:
    """For each window start: whether an equal window starts before in the same document."""
    out = np.zeros(len(units.windows) + 1, np.int64)
    order = np.lexsort((r.start, r.kind, r.seed, r.doc))
    doc, seed, kind = r.doc[order], r.seed[order], r.kind[order]
    head = scan.first_of_runs(doc, seed, kind)
    late = order[~head]
    np.add.at(out, r.start[late], 1)
    np.add.at(out, r.last[late] + 1, -1)
    hit = np.cumsum(out)[:-1] > 0
    # Buckets of one document that still hold different regions: position by position.
    doc, seed, order = doc[head], seed[head], order[head]
    bucket = np.cumsum(scan.first_of_runs(doc, seed)) - 1
    many = order[(np.bincount(bucket)[bucket] > 1)] if len(bucket) else order
    of, place = scan.within(r.last[many] - r.start[many] + 1)
    x = r.start[many][of] + place
    d, w = r.doc[many][of], units.windows[x]
    by = np.lexsort((x, w, d))
    hit[x[by[~scan.first_of_runs(d[by], w[by])]]] = True
    return hit


def _clean(length: int, listed: bool):
    read = _units(length)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys, prints = b.column(KEY).to_numpy(), b.column(PRINT).to_numpy()
            for i, j, texts in scan.slices(b.column("text")):
                units = read(texts)
                if listed:
                    regions, hit = repeated_windows(units, b.column("kinds").slice(i, j - i), b.column("windows").slice(i, j - i))
                    hit |= again_in_document(units, regions)
                else:
                    hit = again_in_document(units, regions_of(units))
                gone = covered(hit, length, len(texts.buf))
                total = np.concatenate([[0], np.cumsum(gone)])[texts.off]
                kept = pa.LargeBinaryArray.from_buffers(pa.large_binary(), j - i, [None, pa.py_buffer((texts.off - total).astype(np.int64)), pa.py_buffer(texts.buf[~gone])])
                yield scan.batch(OUT, keys[i:j], prints[i:j], np.diff(texts.off), np.diff(total), spans_of(gone, texts.off), kept)

    return run


def dedup_bytes(docs: DataFrame, length: int = 100) -> DataFrame:
    """Row key, n_bytes, n_removed, spans (of removed bytes) and kept bytes of every row."""
    texts = row_texts(docs)
    found = repeated_in_smaller(texts, _units(length), "op10")
    hit, rest = with_found(texts, found, "op10")
    return hit.mapInArrow(_clean(length, True), OUT_SQL).unionByName(rest.mapInArrow(_clean(length, False), OUT_SQL))


def op10_suffix_dedup(spark, sf_dir) -> DataFrame:
    out = dedup_bytes(table(spark, sf_dir, "documents"))
    return out.select(id_back(), "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


SQL = {
    "op10_suffix_dedup": r"""
WITH doc AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, octet_length(encode(coalesce(text, ''))) AS n FROM documents),
win AS (SELECT doc_id, i, md5(substr(h, CAST(2 * i + 1 AS BIGINT), 200)) AS m FROM (SELECT doc_id, h, unnest(range(0, CAST(n - 99 AS BIGINT))) AS i FROM doc WHERE n >= 100)),
again AS (SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY m ORDER BY doc_id, i) AS r FROM win) WHERE r > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 100)) AS place FROM again),
runs AS (SELECT doc_id, count(*) FILTER (WHERE before IS NULL OR before < place - 1) AS n_spans FROM (SELECT doc_id, place, lag(place) OVER (PARTITION BY doc_id ORDER BY place) AS before FROM gone) GROUP BY doc_id),
bytes AS (SELECT doc_id, unnest(range(0, CAST(n AS BIGINT))) AS place, h FROM doc),
kept AS (SELECT doc_id, count(*) AS k, string_agg(substr(h, CAST(2 * place + 1 AS BIGINT), 2), '' ORDER BY place) AS said FROM bytes ANTI JOIN gone USING (doc_id, place) GROUP BY doc_id)
SELECT doc.doc_id, CAST(n AS BIGINT) AS n_bytes, CAST(n - coalesce(k, 0) AS BIGINT) AS n_removed, coalesce(n_spans, 0) AS n_spans, sha256(unhex(coalesce(said, ''))) AS kept_sha256
FROM doc LEFT JOIN kept USING (doc_id) LEFT JOIN runs USING (doc_id)
"""
}
QUERIES = {"op10_suffix_dedup": op10_suffix_dedup}
