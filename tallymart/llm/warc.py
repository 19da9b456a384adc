"""A deterministic, sharded WARC writer and the reader of its archives.

1. Every page's record is made and compressed once, as a gzip member of its own. Records are range-sorted by page_id; running sums of
   the sizes (within ranges by a window, across ranges by the ranges' sums) mark each record that begins an archive: a new one begins
   whenever `roll_bytes` are full. That depends on pages alone, not on how many tasks there are.
2. Records are dealt by lots of consecutive archives, at most `LOTS` of them, so that the list of the lots' first records stays small
   however many archives there are. Marks are sorted in among the records of their lot: a task writes one archive from each mark to the
   next, records in order, under a temporary name with the attempt in it. Headers and digests are made from the payload; a payload
   already seen is a revisit record that refers to the response.
3. Tasks return name, size, records and digest of what they wrote; Spark keeps one attempt of each. A second job gives those files
   their final names, which can be repeated at will. The manifest is written last: an archive counts if it is in the manifest.

Executors write through Arrow's file systems, so the folder's scheme must be one of those (a path or file:, s3:, gs:, hdfs:).

Defined cases: a null html is an empty payload; a null url gives no target URI; a null page_id sorts first, its record has no page id
and it is never referred to; rows that share a page_id each get a record, and are told apart by their place in the archive only; of
equal large payloads, all rows with the largest page_id are responses. An empty table gives no archive and an empty result.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallymart.llm.shared import NO_ID, folder, narrow, ship, stored, table

DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
ID = "urn:x-page:"
SMALL = 1000
STEP = 1 << 14
#: Tables of revisits and of archives are broadcast up to so many rows; beyond it the same joins shuffle.
BROADCAST_ROWS = 500_000
#: Lots of consecutive archives: the driver and every task know the first record of each lot, not of each archive.
LOTS = 20_000


def record(page: int, url: str | None, payload: bytes, refers: int | None, date: str = DATE) -> bytes:
    """A whole record: response, or revisit of the page `refers`, whose block is the HTTP header alone."""
    digest = "sha1:" + base64.b32encode(hashlib.sha1(payload).digest()).decode()
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http + payload if refers is None else http
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers is None else 'revisit'}"]
    if page != NO_ID:
        head.append(f"WARC-Record-ID: <{ID}{page}>")
    else:
        head.append(f"WARC-Record-ID: <urn:sha1:{hashlib.sha1(payload).hexdigest()}>")
    if url:
        head.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url))
    head += [f"WARC-Date: {date}", f"WARC-Payload-Digest: {digest}"]
    if refers is not None:
        head += [f"WARC-Refers-To: <{ID}{refers}>", f"WARC-Profile: {PROFILE}"]
    head += ["WARC-Block-Digest: sha1:" + base64.b32encode(hashlib.sha1(block).digest()).decode(), "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def member(data: bytes) -> bytes:
    """A gzip member without time or name: equal data give equal bytes."""
    made = zlib.compressobj(6, zlib.DEFLATED, 31)
    return made.compress(data) + made.flush()


def _members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each page's record, compressed: what goes into an archive as it is."""
    for b in batches:
        for start in range(0, b.num_rows, 256):
            part = b.slice(start, 256)
            rows = zip(*(part.column(c).to_pylist() for c in ("page", "url", "html", "refers")), strict=True)
            made = [member(record(page, url, (html or "").encode(), refers)) for page, url, html, refers in rows]
            sizes = pa.array([len(m) for m in made], pa.int64())
            yield pa.RecordBatch.from_arrays([part.column("page"), part.column("print"), sizes, pa.array(made, pa.binary())], names=["page", "print", "size", "member"])


DEALT = "lot long, page long, print long, archive long, member binary"


def _dealt(pages: np.ndarray, prints: np.ndarray):
    """Adds the lot of each member: the last whose first (page, print) is not behind it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            page, prints_ = b.column("page").to_numpy(), b.column("print").to_numpy()
            low, high = np.searchsorted(pages, page, "left"), np.searchsorted(pages, page, "right")
            lot = low - 1
            for k in np.flatnonzero(high > low):  # a lot begins with this page: its print decides
                lot[k] = low[k] - 1 + np.searchsorted(prints[low[k] : high[k]], prints_[k], "right")
            columns = [pa.array(lot.astype(np.int64)), b.column("page"), b.column("print"), pa.nulls(b.num_rows, pa.int64()), b.column("member")]
            yield pa.RecordBatch.from_arrays(columns, names=["lot", "page", "print", "archive", "member"])

    return run


WRITTEN = "archive long, part string, bytes long, records long, sha1 string"


def _write(base: str):
    """Archives one after the other, each streamed to its temporary file. A row with an archive marks where it begins."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, top = fs.FileSystem.from_uri(base)
        attempt = uuid.uuid4().hex
        store.create_dir(f"{top}/_parts", recursive=True)
        now, open_now, out, done = None, None, None, []

        def close():
            out[0].close()
            done.append((open_now, out[1], out[2], out[3], out[4].hexdigest()))

        for b in batches:
            for archive, data in zip(b.column("archive").to_pylist(), b.column("member"), strict=True):
                if archive is not None:
                    now = archive
                    continue
                if now != open_now:
                    if out:
                        close()
                    part = f"_parts/{now:08d}-{attempt}.warc.gz"
                    open_now, out = now, [store.open_output_stream(f"{top}/{part}", compression=None), part, 0, 0, hashlib.sha1()]
                data = data.as_py()
                out[0].write(data)
                out[4].update(data)
                out[2] += len(data)
                out[3] += 1
        if out:
            close()
        names = ["archive", "part", "bytes", "records", "sha1"]
        types = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string()]
        yield pa.RecordBatch.from_arrays([pa.array([d[k] for d in done], t) for k, t in enumerate(types)], names=names)

    return run


def _commit(base: str):
    """Gives files their final names; one that has it already is left."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, top = fs.FileSystem.from_uri(base)
        for b in batches:
            for archive, part in zip(b.column("archive").to_pylist(), b.column("part").to_pylist(), strict=True):
                try:
                    store.move(f"{top}/{part}", f"{top}/{name_of(archive)}")
                except OSError:
                    if store.get_file_info(f"{top}/{name_of(archive)}").type != fs.FileType.File:
                        raise
            names = pa.array([name_of(a) for a in b.column("archive").to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([b.column("archive"), names, *(b.column(c) for c in ("bytes", "records", "sha1"))], names=["archive", "file", "bytes", "records", "sha1"])

    return run


def name_of(archive: int) -> str:
    return f"pages-{archive:08d}.warc.gz"


def referred(pages: DataFrame, small: int = SMALL) -> DataFrame:
    """page, print, url, html, refers: the page each revisit refers to, null for responses."""
    html = F.coalesce("html", F.lit(""))
    rows = pages.select(F.coalesce(F.col("page_id").cast("long"), F.lit(NO_ID)).alias("page"), "url", "html", F.xxhash64("url", "html").alias("print"))
    sums = rows.select("page", "print", F.sha1(html).alias("sha1")).where(F.octet_length(html) >= small)
    most = sums.groupBy("sha1").agg(F.max("page").alias("last"), F.count(F.lit(1)).alias("n")).where("n > 1").select("sha1", "last")
    later = sums.join(most, "sha1").where((F.col("page") < F.col("last"))).select("page", "print", F.col("last").alias("refers")).distinct()
    # Stored, so that counting it does not make all digests a second time.
    return rows.join(narrow(stored(later, "op6-revisits"), BROADCAST_ROWS), ["page", "print"], "left")


def begun(sizes: DataFrame, roll_bytes: int) -> tuple[DataFrame, int]:
    """archive, page, print: the record that begins each archive, and how many archives there are. sizes: page, print, size.

    Archives are numbered from 0. Where rows equal in page and print begin several, their records all go to the last of these, and the
    others get no file.
    """
    spark = sizes.sparkSession
    # Written, so that a row stays in its range however often it is read.
    ranged = stored(sizes.repartitionByRange("page", "print").withColumn("range", F.spark_partition_id()), "op6-sizes")
    place = F.struct("page", "print")
    sums = ranged.groupBy("range").agg(F.sum("size").alias("sum"), F.max_by("size", place).alias("last")).orderBy("range").collect()  # one row per task
    before, total, fill = [], 0, -1
    for r in sums:
        before.append((r["range"], total, fill))
        total += r["sum"]
        fill = (total - r["last"]) // roll_bytes
    offsets = F.broadcast(spark.createDataFrame(before, "range int, before long, fill_before long"))
    order = Window.partitionBy("range").orderBy("page", "print")
    inside = F.coalesce(F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    summed = ranged.select("range", "page", "print", inside.alias("inside")).join(offsets, "range")
    full = F.floor((F.col("before") + F.col("inside")) / roll_bytes)
    filled = summed.withColumn("fill", full)
    previous = F.coalesce(F.lag("fill").over(Window.partitionBy("range").orderBy("page", "print", "fill")), F.col("fill_before"))
    marks = stored(filled.withColumn("previous", previous).where("fill > previous").select("range", "fill", "page", "print"), "op6-marks")
    counts = marks.groupBy("range").count().orderBy("range").collect()  # one row per task
    earlier, count = [], 0
    for r in counts:
        earlier.append((r["range"], count))
        count += r["count"]
    place_in_range = F.row_number().over(Window.partitionBy("range").orderBy("fill")) - 1
    numbers = F.broadcast(spark.createDataFrame(earlier, "range int, earlier long"))
    numbered = marks.withColumn("place", place_in_range).join(numbers, "range")
    return numbered.select((F.col("earlier") + F.col("place")).alias("archive"), "page", "print"), count


def write_archives(pages: DataFrame, base: str, roll_bytes: int = 16 << 20, small: int = SMALL, lots: int = LOTS) -> DataFrame:
    """Writes pages below `base` and returns the manifest: archive, file, bytes, records, sha1."""
    spark = pages.sparkSession
    ship(spark)
    rows = referred(pages, small)
    members = stored(rows.mapInArrow(_members, "page long, print long, size long, member binary"), "op6-members")
    marks, count = begun(members.select("page", "print", "size"), roll_bytes)
    each = max(1, -(-count // lots))  # archives in a lot
    firsts = sorted((r["page"], r["print"]) for r in marks.where(F.col("archive") % each == 0).collect())  # at most `lots` rows
    edges = [np.array([f[k] for f in firsts], np.int64) for k in (0, 1)]
    marked = marks.select(F.floor(F.col("archive") / each).alias("lot"), "page", "print", "archive", F.lit(None).cast("binary").alias("member"))
    dealt = members.select("page", "print", "member").mapInArrow(_dealt(*edges), DEALT).unionByName(marked)
    order = ["lot", "page", "print", F.asc_nulls_last("archive")]
    written = dealt.repartition("lot").sortWithinPartitions(*order).mapInArrow(_write(base), WRITTEN)
    written = stored(written, "op6-written")
    committed = written.select("archive", "part", "bytes", "records", "sha1").mapInArrow(_commit(base), "archive long, file string, bytes long, records long, sha1 string")
    committed.write.mode("overwrite").parquet(f"{base}/manifest")
    return spark.read.parquet(f"{base}/manifest")


READ = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload string"
READ_SCHEMA = pa.schema(
    [("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload", pa.string())]
)


def parse(data: bytes) -> Iterator[dict]:
    """Records of a gzip archive, one member each. Reads on by small steps: what is left of the archive is never copied."""
    view, at = memoryview(data), 0
    while at < len(view):
        opened, parts = zlib.decompressobj(31), []
        while not opened.eof:
            step = view[at : at + STEP]
            if not len(step):
                raise ValueError("an archive ends within a record")
            parts.append(opened.decompress(step))
            at += len(step) - len(opened.unused_data)
        raw = b"".join(parts)
        head, _, rest = raw.partition(b"\r\n\r\n")
        fields = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
        block = rest[: int(fields["Content-Length"])]
        if "sha1:" + base64.b32encode(hashlib.sha1(block).digest()).decode() != fields["WARC-Block-Digest"]:
            raise ValueError("a record's block does not have its digest")
        http, _, payload = block.partition(b"\r\n\r\n")
        page, refers = (re.fullmatch(f"<{ID}(-?[0-9]+)>", fields.get(k, "")) for k in ("WARC-Record-ID", "WARC-Refers-To"))
        yield {
            "page_id": int(page[1]) if page else None,
            "url": fields.get("WARC-Target-URI"),
            "payload_bytes": int(re.search(rb"Content-Length: ([0-9]+)", http)[1]),
            "payload_digest": base64.b32decode(fields["WARC-Payload-Digest"][5:]).hex(),
            "record_type": fields["WARC-Type"],
            "refers_to": int(refers[1]) if refers else None,
            "payload": payload.decode() if fields["WARC-Type"] == "response" else None,
        }


def _parsed(with_payload: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [f for f in READ_SCHEMA.names if with_payload or f != "payload"]
        schema = pa.schema([READ_SCHEMA.field(n) for n in names])
        for b in batches:
            for data, size, sha1 in zip(*(b.column(c) for c in ("content", "bytes", "sha1")), strict=True):
                data = data.as_py()
                if len(data) != size.as_py() or hashlib.sha1(data).hexdigest() != sha1.as_py():
                    raise ValueError("an archive is not as the manifest has it")
                rows = []
                for r in parse(data):
                    rows.append({k: r[k] for k in names})
                    if len(rows) == 1000:
                        yield pa.RecordBatch.from_pylist(rows, schema=schema)
                        rows = []
                yield pa.RecordBatch.from_pylist(rows, schema=schema)

    return run


def read_archives(spark: SparkSession, base: str, with_payload: bool = True) -> DataFrame:
    """Records of the archives that the manifest names, with their digests checked. A task holds one archive at a time."""
    ship(spark)
    manifest = spark.read.parquet(f"{base}/manifest")
    files = spark.read.format("binaryFile").option("pathGlobFilter", "pages-*.warc.gz").load(base)
    files = files.select(F.element_at(F.split("path", "/"), -1).alias("file"), "content")
    found = files.join(narrow(manifest.select("file", "bytes", "sha1"), BROADCAST_ROWS), "file")
    return found.mapInArrow(_parsed(with_payload), READ if with_payload else READ.rpartition(",")[0])


def op6_warc(spark, sf_dir) -> DataFrame:
    base = folder(spark, "op6-archives")
    manifest = write_archives(table(spark, sf_dir, "pages"), base)
    if manifest.isEmpty():
        return spark.createDataFrame([], "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long")
    return read_archives(spark, base, with_payload=False).drop("url")


SQL = {
    "op6_warc": """
WITH p AS (SELECT page_id, coalesce(html, '') AS html, CAST(octet_length(encode(coalesce(html, ''))) AS BIGINT) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages),
last AS (SELECT html, max(page_id) AS top FROM p WHERE payload_bytes >= 1000 GROUP BY html)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id < top THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN page_id < top THEN top END AS refers_to
FROM p LEFT JOIN last USING (html)
"""
}
QUERIES = {"op6_warc": op6_warc}
