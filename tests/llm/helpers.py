"""Small tables for the operators' tests, and plain Python versions of what they compute."""

import hashlib
import re
import string

from pyspark.sql.types import LongType, StringType, StructField, StructType

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)
SPACE = "\x20\x09\x0a\x0b\x0c\x0d"

#: Columns whose names the operators use inside themselves.
CLASHING = ["_k", "_f", "kept", "marks", "cid", "n", "token", "verdict", "score", "words", "kind"]


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def sha256(data):
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


def frame(spark, rows, id_column="doc_id", text_column="text", extra=()):
    """Rows of (id, text), dealt over a few partitions, with columns of clashing names."""
    fields = [StructField(id_column, LongType()), StructField(text_column, StringType()), *[StructField(c, StringType()) for c in extra]]
    return spark.createDataFrame([(i, t, *["x"] * len(extra)) for i, t in rows], StructType(fields)).repartition(3)


def save(df, folder, name):
    df.coalesce(1).write.mode("overwrite").parquet(f"{folder}/{name}.parquet")


def lorem(seed, n):
    """n made-up words that follow from the seed."""
    out, x = [], seed * 7919 + 17
    for _ in range(n):
        x = (x * 6364136223846793005 + 1442695040888963407) % 2**64
        out.append("".join(string.ascii_lowercase[(x >> s) % 26] for s in (20, 27, 34, 41, 48)[: 2 + (x >> 60) % 4]))
    return out


def edge_documents():
    """Null and empty texts, a null id, ties, copies, near copies, repeated passages and lines, and a long text."""
    base, other, passage = lorem(1, 120), lorem(2, 200), lorem(3, 70)
    near = [*base[:60], "changed", *base[61:]]
    line = "This line stands in many documents. "
    rows = [
        (0, None),
        (1, ""),
        (2, "   \n \t "),
        (3, " ".join(base)),
        (4, " ".join(base)),
        (5, " ".join(near)),
        (6, " ".join(other[:80] + passage + other[80:])),
        (7, "\n".join([" ".join(passage), line, "tail " * 30])),
        (8, "\n".join([line, "own words here", line.upper(), "x"])),
        (9, "  " + line + "\nend"),
        (10, "é" * 150 + " " + "ö" * 150),
        (11, "ab" * 200),
        (12, "short"),
        (13, "SHORT"),
        (14, " ".join(lorem(5, 4000))),
        (15, " ".join(lorem(5, 4000)[300:900])),
        (16, "one two three four"),
        (17, "One  two\nthree four"),
        (18, "\n".join([" ".join(lorem(6, 60))] * 3)),
        (19, "<|endoftext|> is text\x85 here   and   there\r\n\r\n"),
        (None, " ".join(base)),
        (None, line),
    ]
    # Rows given twice, and ids with several texts.
    again = [rows[3], rows[3], rows[1], rows[8], rows[18], (6, " ".join(["other", *passage, "text"])), (15, line + "\nsame id, other text"), (16, None)]
    return [*rows, *again]
