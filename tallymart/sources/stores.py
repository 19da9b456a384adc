"""Reads that Spark's file scans cannot say: the first line of a file alone, and the files those scans pass over.

Tasks open the store themselves, through Arrow. That needs a scheme Arrow knows and credentials it finds on the executors, so callers
name the schemes for which this holds. The functions that tasks run are closures: executors need Arrow, but not this package.
"""

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Mounted folders, which executors must see for Spark's scans anyway. Others, such as hdfs, can be named by the caller.
DIRECT = frozenset({"file"})
BLOCK = 1 << 16
FOLDERS_PER_ROUND = 1000
HIDDEN = "hidden name"
EMPTY = "empty file"
_HEADS = "file_uri string, header_line string"
_FOUND = "file_location string, file_name string, modification_time timestamp, length bigint, reason string, is_folder boolean"


def scheme(location: str) -> str:
    """`file` of file:/a/b; empty where there is none."""
    head, colon, _ = location.partition(":")
    return head if colon and "/" not in head else ""


def _opener():
    """A function from a location, as Spark writes it, to Arrow's file system and path. File systems are opened once per task."""
    stores = {}

    def opened(location: str):
        from pyarrow import fs

        kind, _, rest = location.partition(":")
        authority, _, path = rest.removeprefix("//").partition("/") if rest.startswith("//") else ("", "", rest.lstrip("/"))
        if (kind, authority) not in stores:
            local = kind == "file"
            stores[kind, authority] = (fs.LocalFileSystem(), "") if local else fs.FileSystem.from_uri(f"{kind}://{authority}/")
        store, top = stores[kind, authority]
        return store, f"{top.rstrip('/')}/{path}"

    return opened


def file_heads(files: DataFrame, block: int = BLOCK) -> DataFrame:
    """The first line with a visible character of each file, read from its start and no further than the block it ends in.

    files: file_location, file_uri. A file without such a line gives no row. A byte order mark is not part of the line; bytes that
    are no UTF-8 are replaced. Blocks double, so that a long line is not searched over and over.
    """
    def first_line(stream) -> str | None:
        import re

        kept, size, at_start = b"", block, True
        while True:
            more = stream.read(size)
            kept += more.removeprefix(b"\xef\xbb\xbf") if at_start else more
            size, at_start = 2 * size, False
            seen = re.search(rb"[^\x00-\x20]", kept)
            if seen:
                end = re.compile(rb"[\r\n]").search(kept, seen.start())
                if end or not more:
                    line = kept[: end.start() if end else len(kept)]
                    start = max(line.rfind(b"\n", 0, seen.start()), line.rfind(b"\r", 0, seen.start())) + 1
                    return line[start:].decode("utf-8", "replace")
            else:
                # Blank lines are not kept, only what may be the beginning of the line.
                kept, size = kept[max(kept.rfind(b"\n"), kept.rfind(b"\r")) + 1 :], block
            if not more:
                return None

    opened = _opener()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow as pa

        for b in batches:
            uris, lines = [], []
            for location, uri in zip(b.column("file_location").to_pylist(), b.column("file_uri").to_pylist(), strict=True):
                store, path = opened(location)
                with store.open_input_file(path) as stream:
                    line = first_line(stream)
                if line is not None:
                    uris.append(uri)
                    lines.append(line)
            yield pa.RecordBatch.from_arrays([pa.array(uris, pa.string()), pa.array(lines, pa.string())], names=["file_uri", "header_line"])

    # A fixed number of parts: the rows are few bytes, so adaptive execution would put all files into one task.
    tasks = files.sparkSession.sparkContext.defaultParallelism
    return files.select("file_location", "file_uri").repartition(tasks, "file_uri").mapInArrow(run, _HEADS)


def _folder_scan(folders_per_round: int):
    """Lists folders and those below them, up to a number of folders for each task; the rest is handed on as folder rows."""
    opened, hidden_name, empty = _opener(), HIDDEN, EMPTY

    def passed_over(name: str) -> bool:
        # The names that Spark's file scans leave out.
        kept = name.startswith(("_metadata", "_common_metadata"))
        return not kept and (name.startswith(".") or (name.startswith("_") and "=" not in name) or name.endswith("._COPYING_"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow as pa
        from pyarrow import fs

        schema = pa.schema(
            [("file_location", pa.string()), ("file_name", pa.string()), ("modification_time", pa.timestamp("us", "UTC"))]
            + [("length", pa.int64()), ("reason", pa.string()), ("is_folder", pa.bool_())]
        )
        left = folders_per_round
        for b in batches:
            folders = [(r["file_location"].rstrip("/"), r["reason"]) for r in b.to_pylist()]
            while folders:
                if left <= 0:
                    rows = [{"file_location": at, "reason": reason, "is_folder": True} for at, reason in folders]
                    yield pa.RecordBatch.from_pylist(rows, schema=schema)
                    break
                at, inside = folders.pop()
                left -= 1
                store, path = opened(at)
                rows = []
                for info in store.get_file_info(fs.FileSelector(path, allow_not_found=True)):
                    name = info.base_name
                    reason = inside or (hidden_name if passed_over(name) else None)
                    if info.type == fs.FileType.Directory:
                        folders.append((f"{at}/{name}", reason))
                    elif reason or info.size == 0:
                        # Spark keeps times in whole milliseconds.
                        stamp = None if info.mtime_ns is None else info.mtime_ns // 1_000_000 * 1_000
                        rows.append((f"{at}/{name}", name, stamp, info.size, reason or empty, False))
                columns = list(zip(*rows, strict=True)) or [[]] * len(schema)
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    return run


def unseen_files(spark: SparkSession, inbox: str, work: str, folders_per_round: int = FOLDERS_PER_ROUND) -> DataFrame:
    """Files below `inbox` that Spark's scans pass over, with the reason: a hidden name, of the file or a folder above it, or no bytes.

    inbox: with its scheme. The folders are listed in rounds: what a task has no room for is dealt out anew in the next one, so
    the number of rounds grows with the logarithm of the folders or with their depth, and one folder is listed in one task. Rounds
    are stored below `work`. A round after the first is rare: a task lists `folders_per_round` folders.
    """
    tasks, path, rounds = spark.sparkContext.defaultParallelism, "", []
    todo = spark.createDataFrame([(inbox.rstrip("/"), None)], "file_location string, reason string").coalesce(1)
    while True:
        path = f"{work}/round-{len(rounds)}"
        todo.mapInArrow(_folder_scan(folders_per_round), _FOUND).write.mode("overwrite").parquet(path)
        rounds.append(path)
        todo = spark.read.schema(_FOUND).parquet(path).where("is_folder").select("file_location", "reason")
        if todo.isEmpty():
            break
        todo = todo.repartition(tasks, "file_location")
    return spark.read.schema(_FOUND).parquet(*rounds).where(~F.col("is_folder")).drop("is_folder")
