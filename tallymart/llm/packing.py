"""Best-fit packing of token sequences, online and with bounded space.

Texts are tokenised, and an end id is put behind each. Only documents longer than a sequence are cut: into whole sequences from the end
on, so that the first piece is the short one. A packer holds at most `open_bins` open bins. An integer is the bitset of the free spaces
that some open bin has: its lowest set bit at or above a piece's length is the best fit. If no bin fits, a new one is opened; if there
are too many, the fullest closes first. A packer lays the pieces of each Arrow batch longest first.

Every task packs the texts it reads, without a shuffle. What a task leaves open is packed again in a second round: bins that are not
full are treated as pieces of their fill and laid together, by fewer packers. Only bins move there, not texts, and the number of such
bins is bounded by tasks times `open_bins`.

Tokenising: byte-level splits never join a character to white space behind it, so a text is cut before white space (`chunks`), and equal
chunks are encoded once per worker, as long as it remembers them. Texts with other white space than ASCII's are encoded whole. Ids equal those of the whole text.

Defined cases: a null or empty text is the end id alone; rows that share an id are packed each; a document of exactly one sequence is one
piece; an empty table gives an empty result.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymart.llm import scan
from tallymart.llm.shared import KEY, PRINT, id_back, keyed, stored, table

#: White space that is not ASCII's, and ASCII's separators, for which cutting before white space is not proven.
OTHER_SPACE = re.compile(rb"[\x1c-\x1f]|\xc2[\x85\xa0]|\xe1\x9a\x80|\xe2\x80[\x80-\x8a\xa8\xa9\xaf]|\xe2\x81\x9f|\xe3\x80\x80")
KNOWN_CHUNKS = 1_000_000


class BestFit:
    """Open bins by free space; at most `open_bins` of them. put() gives a bin number and the place in it."""

    def __init__(self, size: int, open_bins: int):
        self.size, self.open_bins = size, open_bins
        self.free: list[list[int]] = [[] for _ in range(size + 1)]
        self.bits = self.opened = self.made = 0

    def put(self, length: int) -> tuple[int, int]:
        fit = self.bits >> length
        if fit:
            space = length + (fit & -fit).bit_length() - 1
            bin_ = self._take(space)
        else:
            if self.opened == self.open_bins:  # the fullest closes
                self._take((self.bits & -self.bits).bit_length() - 1)
            space, bin_ = self.size, self.made
            self.made += 1
        rest = space - length
        if rest:  # a full bin is closed
            self.free[rest].append(bin_)
            self.bits |= 1 << rest
            self.opened += 1
        return bin_, self.size - space

    def _take(self, space: int) -> int:
        bin_ = self.free[space].pop()
        if not self.free[space]:
            self.bits &= ~(1 << space)
        self.opened -= 1
        return bin_

    def left(self) -> list[tuple[int, int]]:
        """(bin, fill) of the bins that are open."""
        return [(b, self.size - space) for space, bins in enumerate(self.free) for b in bins]


class Encoder:
    """Ids of whole slices. Holds the ids of at most KNOWN_CHUNKS chunks."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        # A byte-level token's string has one character for each of its bytes.
        self.bytes = np.array([len(self.tokenizer.id_to_token(i) or "") for i in range(self.tokenizer.get_vocab_size())], np.int64)
        self._forget()

    def _forget(self) -> None:
        self.known = np.zeros(0, np.uint64)  # hashes of chunks, sorted
        self.place = np.zeros(0, np.int64)  # where a chunk's ids are
        self.count = np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.uint32)

    def _singly(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        found = [e.ids for e in self.tokenizer.encode_batch([t.decode() for t in texts], add_special_tokens=False)]
        count = np.fromiter(map(len, found), np.int64, len(found))
        return np.fromiter((i for ids in found for i in ids), np.uint32, int(count.sum())), count

    def _joined(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Chunks that begin with white space and do not end with it, as one text: cut again where their bytes end."""
        if not texts:
            return np.zeros(0, np.uint32), np.zeros(0, np.int64)
        ids = np.array(self.tokenizer.encode(b"".join(texts).decode(), add_special_tokens=False).ids, np.uint32)
        ends = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)))
        reached = np.cumsum(self.bytes[ids])
        last = np.searchsorted(reached, ends)
        if reached[-1] != ends[-1] or (reached[last] != ends).any():
            return self._singly(texts)
        return ids, np.diff(last + 1, prepend=0)

    def encode(self, texts: scan.Texts) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all documents, where each document's begin)."""
        buf, off = texts.buf, texts.off
        space = scan.SPACE[buf]
        cut = np.zeros(len(buf) + 1, bool)
        cut[1:-1] = space[1:] & ~space[:-1]
        cut[off] = True
        odd = np.zeros(len(texts), bool)
        for m in OTHER_SPACE.finditer(buf.tobytes()):  # such a document is one chunk
            odd[int(np.searchsorted(off, m.start(), "right")) - 1] = True
        for d in np.flatnonzero(odd):
            cut[off[d] + 1 : off[d + 1]] = False
        start = np.flatnonzero(cut[:-1])
        end = np.append(start[1:], len(buf))
        first = np.searchsorted(start, off)
        hashes = scan.spans_hash(scan.byte_sums(buf), start, end)
        new, at, which = np.unique(hashes, return_index=True, return_inverse=True)
        joins = space[start] & ~space[end - 1] & ~np.repeat(odd, np.diff(first)) if len(start) else np.zeros(0, bool)
        place, count = self._look_up(new, at, buf, start, end, joins)
        # The ids of all chunks in order.
        n = count[which]
        total = np.concatenate([[0], np.cumsum(n)])
        ids = self.ids[np.repeat(place[which] - total[:-1], n) + np.arange(total[-1])]
        return ids, total[first]

    def _look_up(self, new, at, buf, start, end, joins) -> tuple[np.ndarray, np.ndarray]:
        if len(self.known) + len(new) > KNOWN_CHUNKS:
            self._forget()
        where = np.searchsorted(self.known, new)
        known = np.zeros(len(new), bool)
        inside = where < len(self.known)
        known[inside] = self.known[where[inside]] == new[inside]
        if not known.all():
            todo = at[~known]
            whole = buf.tobytes()
            texts = [whole[a:b] for a, b in zip(start[todo].tolist(), end[todo].tolist(), strict=True)]
            count, place = np.zeros(len(todo), np.int64), np.zeros(len(todo), np.int64)
            for pick, encode in ((np.flatnonzero(joins[todo]), self._joined), (np.flatnonzero(~joins[todo]), self._singly)):
                ids, n = encode([texts[k] for k in pick.tolist()])
                count[pick], place[pick] = n, len(self.ids) + np.cumsum(n) - n
                self.ids = np.concatenate([self.ids, ids])
            into = where[~known]
            self.known, self.place, self.count = (np.insert(x, into, y) for x, y in ((self.known, new[~known]), (self.place, place), (self.count, count)))
            where = np.searchsorted(self.known, new)
        return self.place[where], self.count[where]


_encoders: dict[str, Encoder] = {}


def encoder_of(path: str) -> Encoder:
    """One per Python worker: what it knows serves all tasks of the worker."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


PIECES = pa.schema(
    [(KEY, pa.int64()), (PRINT, pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("task", pa.int64()), ("bin", pa.int64()), ("offset", pa.int64()), ("fill", pa.int64()), ("ids", pa.list_(pa.int64()))]
)
PIECES_SQL = f"{KEY} long, {PRINT} long, piece int, start long, length long, ids_crc32 long, task long, bin long, offset long, fill long"


def _pieces(tokenizer: str, end_id: int, size: int, open_bins: int, with_ids: bool):
    """Pieces with their bin in this task. Bins left open at the end come as rows of their own: piece -1, and their fill."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, packer, task = encoder_of(tokenizer), BestFit(size, open_bins), TaskContext.get().partitionId()
        schema = PIECES if with_ids else pa.schema(list(PIECES)[:-1])
        for b in batches:
            keys, prints = b.column(KEY).to_numpy(), b.column(PRINT).to_numpy()
            for i, j, texts in scan.slices(b.column("text")):
                ids, first = encoder.encode(texts)
                ids = np.insert(ids, first[1:], np.uint32(end_id))
                first = first + np.arange(len(first))
                tokens = np.diff(first)
                pieces = -(-tokens // size)
                doc, piece = scan.within(pieces)
                short = tokens - (pieces - 1) * size  # length of the first piece
                begin = np.where(piece > 0, short[doc] + (piece - 1) * size, 0)
                length = np.where(piece > 0, size, short[doc])
                order = np.argsort(-length, kind="stable")
                bins, places = np.zeros(len(doc), np.int64), np.zeros(len(doc), np.int64)
                for k, n in zip(order.tolist(), length[order].tolist(), strict=True):
                    bins[k], places[k] = packer.put(n)
                at = first[doc] + begin
                raw, little = at * 4, ids.astype("<u4").tobytes()
                crc = [zlib.crc32(memoryview(little)[a : a + 4 * n]) for a, n in zip(raw.tolist(), length.tolist(), strict=True)]
                columns = [keys[i:j][doc], prints[i:j][doc], piece, begin, length, crc, np.full(len(doc), task), bins, places, np.zeros(len(doc), np.int64)]
                if with_ids:  # pieces are in the order of the ids
                    columns.append(pa.ListArray.from_arrays(pa.array(np.append(at, len(ids)), pa.int32()), pa.array(ids.astype(np.int64))))
                yield scan.batch(schema, *columns)
        left = packer.left()
        if left:
            bins, fill = (np.array(x, np.int64) for x in zip(*left, strict=True))
            zero = np.zeros(len(left), np.int64)
            columns = [zero, zero, zero - 1, zero, zero, zero, zero + task, bins, zero, fill]
            if with_ids:
                columns.append(pa.nulls(len(left), PIECES.field("ids").type))
            yield scan.batch(schema, *columns)

    return run


AGAIN = "task long, bin long, group long, joined long, shift long"


def _again(size: int, open_bins: int):
    def run(rows):
        import pandas as pd

        packer = BestFit(size, open_bins)
        rows = rows.sort_values(["fill", "task", "bin"], ascending=[False, True, True])
        placed = [packer.put(n) for n in rows["fill"].tolist()]
        return pd.DataFrame({"task": rows["task"], "bin": rows["bin"], "group": rows["group"], "joined": [p[0] for p in placed], "shift": [p[1] for p in placed]})

    return run


def pack(docs: DataFrame, tokenizer: str, end_id: int, size: int = 1024, open_bins: int = 4096, group_bins: int = 200_000, with_ids: bool = False) -> DataFrame:
    """One row per piece: row key, piece, start, length, ids_crc32, sequence_id, offset, and with_ids the ids themselves.

    Bins of the second round are dealt into groups of about group_bins, one packer each."""
    made = keyed(docs).mapInArrow(_pieces(tokenizer, end_id, size, open_bins, with_ids), PIECES_SQL + (", ids array<long>" if with_ids else ""))
    made = stored(made, "op4-pieces")
    left = made.where("piece < 0").select("task", "bin", "fill")
    groups = max(1, -(-left.count() // group_bins))
    again = left.withColumn("group", F.pmod(F.xxhash64("task", "bin"), F.lit(groups))).groupBy("group").applyInPandas(_again(size, open_bins), AGAIN)
    pieces = made.where("piece >= 0").join(again, ["task", "bin"], "left")
    # Numbers of closed bins are even, those of joined bins odd.
    closed = (F.col("task") * (1 << 31) + F.col("bin")) * 2
    joined = (F.col("group") * (1 << 31) + F.col("joined")) * 2 + 1
    return pieces.select(
        KEY,
        PRINT,
        "piece",
        "start",
        "length",
        "ids_crc32",
        F.coalesce(joined, closed).alias("sequence_id"),
        (F.col("offset") + F.coalesce("shift", F.lit(0))).cast("long").alias("offset"),
        *(["ids"] if with_ids else []),
    )


def packed(docs: DataFrame) -> DataFrame:
    import public_tokenizers

    pieces = pack(docs, public_tokenizers.path("byte_bpe_50k.json"), 2)
    return pieces.select(id_back(), "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op4_best_fit_packing(spark, sf_dir) -> DataFrame:
    return packed(table(spark, sf_dir, "documents"))


SQL = {}
QUERIES = {"op4_best_fit_packing": op4_best_fit_packing}
