"""Files that tasks open themselves: heads of files, and what Spark's scans pass over."""

import subprocess
import sys

import pytest
from pyspark import cloudpickle

from fixtures import HEADER, dimensions, sale, write_csv
from tallymart.errors import NoSourceFiles
from tallymart.plans.batch import Layout, Options, run_batch
from tallymart.schemas import IGNORED, MANIFEST
from tallymart.sources import files, stores
from tallymart.sources.tables import read_store

TEXTS = {
    "plain": b"a,b\n1,2\n",
    "windows": b"\r\n  \r\na,b\r\n1,2\r\n",
    "old": b"a,b\r1,2\r",
    "mark": b"\xef\xbb\xbfa,b\n1,2\n",
    "indented": b"\n\t a,b \n1,2\n",
    "only": b"a,b",
    "blank": b" \n\t\n",
    "spaces": b" " * 100,
    "accents": "\nété,b\n".encode(),
    "wide": b"\n\n" + b"c" * 300 + b",d\n1,2\n",
    "late": b"\n" * 300 + b" \t" * 9 + b"a,b\n",
    "no utf-8": b"a\xff,b\n1,2\n",
    "odd [1] %20{x}": b"a,b\n",
}


@pytest.mark.parametrize("block", [4, 7, 64, stores.BLOCK])
def test_heads_equal_the_text_pass(spark, tmp_path, block):
    inbox = tmp_path / "inbox"
    inbox.mkdir()
    for name, content in TEXTS.items():
        (inbox / f"{name}.csv").write_bytes(content)
    (inbox / "notes.txt").write_bytes(b"a,b\n")
    listing = files.list_files(spark, str(inbox)).where("file_name like '%.csv'")
    got = {tuple(r) for r in stores.file_heads(listing, block).collect()}
    assert len(got) == len(TEXTS) - 2
    assert got == {tuple(r) for r in files.header_lines(spark, str(inbox), direct=frozenset()).collect()}
    if block == stores.BLOCK:
        assert got == {tuple(r) for r in files.header_lines(spark, str(inbox)).collect()}
        assert got == {tuple(r) for r in files.header_lines(spark, str(inbox), small=0).collect()}


def test_a_head_is_read_to_the_end_of_its_block_only(spark, tmp_path):
    inbox = tmp_path / "inbox"
    inbox.mkdir()
    big = inbox / "big.csv"
    with big.open("wb") as out:
        out.write(b"a,b\n")
        out.truncate(4 << 30)  # a hole: reading it whole would take long
    (row,) = files.header_lines(spark, str(inbox)).collect()
    assert row.header_line == "a,b"


def test_tasks_need_arrow_but_not_this_package(tmp_path):
    (tmp_path / "_a.csv").write_text("x")
    (tmp_path / "run.pickle").write_bytes(cloudpickle.dumps(stores._folder_scan(9)))
    code = (
        "import pickle, sys, pyarrow as pa; sys.modules['tallymart'] = None;"
        "from pyspark import cloudpickle; run = pickle.load(open('run.pickle', 'rb'));"
        "b = pa.RecordBatch.from_pydict({'file_location': ['file:' + sys.argv[1]], 'reason': pa.array([None], pa.string())});"
        "print([r['reason'] for x in run(iter([b])) for r in x.to_pylist() if r['file_name'] == '_a.csv'])"
    )
    out = subprocess.run([sys.executable, "-c", code, str(tmp_path)], cwd=tmp_path, capture_output=True, text=True, check=True)
    assert out.stdout.strip() == "['hidden name']"


def inbox_with_unseen(tmp_path):
    inbox = tmp_path / "inbox"
    write_csv(inbox / "a.csv", HEADER, [sale(1, 121, 1, "2023-03-04", 50)])
    write_csv(inbox / "month=3" / "_kept=1" / "b.csv", HEADER, [sale(2, 121, 1, "2023-03-05", 50)])
    write_csv(inbox / "_hidden.csv", HEADER, [])
    write_csv(inbox / "_staging" / "deep" / "c.csv", HEADER, [])
    write_csv(inbox / "late" / "d.csv._COPYING_", HEADER, [])
    (inbox / "late" / "empty.csv").write_text("")
    (inbox / "late" / ".empty").write_text("")
    return inbox


UNSEEN = {
    "_hidden.csv": "hidden name",
    "_staging/deep/c.csv": "hidden name",
    "late/d.csv._COPYING_": "hidden name",
    "late/empty.csv": "empty file",
    "late/.empty": "hidden name",
}


@pytest.mark.parametrize("folders", [1, 2, 1000])
def test_listings_complete_each_other(spark, tmp_path, folders):
    inbox = inbox_with_unseen(tmp_path)
    rows = stores.unseen_files(spark, f"file:{inbox}", str(tmp_path / "work"), folders).collect()
    assert {r.file_location.split("/inbox/")[1]: r.reason for r in rows} == UNSEEN and len(rows) == len(UNSEEN)
    shown = {r.file_location for r in files.list_files(spark, str(inbox)).collect()}
    every = {f"file:{p}" for p in inbox.rglob("*") if p.is_file()}
    assert shown | {r.file_location for r in rows} == every and not shown & {r.file_location for r in rows}
    for r in rows:
        path = tmp_path / "inbox" / r.file_location.split("/inbox/")[1]
        assert r.length == path.stat().st_size and r.file_name == path.name
        assert int(r.modification_time.timestamp() * 1000) == path.stat().st_mtime_ns // 1_000_000


def test_runs_record_unseen_files_once(spark, tmp_path):
    inbox, layout, dims = inbox_with_unseen(tmp_path), Layout(str(tmp_path / "out")), dimensions(spark)

    def recorded():
        rows = read_store(spark, layout.manifest, MANIFEST).where(f"status = '{IGNORED}'").collect()
        return sorted((r.file_location.split("/inbox/")[1], r.reason) for r in rows)

    (result,) = run_batch(spark, str(inbox), dims, layout, run_id="1")
    assert (result.accepted, result.rejected) == (2, 0)
    assert recorded() == sorted(UNSEEN.items())
    with pytest.raises(NoSourceFiles):
        run_batch(spark, str(inbox), dims, layout, run_id="2")
    assert recorded() == sorted(UNSEEN.items())
    # The empty file is filled: a new delivery, which scans show.
    write_csv(inbox / "late" / "empty.csv", HEADER, [sale(3, 121, 1, "2023-03-06", 50)])
    (result,) = run_batch(spark, str(inbox), dims, layout, run_id="3")
    assert (result.accepted, result.rejected) == (1, 0)
    assert recorded() == sorted(UNSEEN.items())


def test_other_stores_take_the_text_pass(spark, tmp_path):
    inbox, layout = inbox_with_unseen(tmp_path), Layout(str(tmp_path / "out"))
    options = Options(direct_schemes=frozenset())
    (result,) = run_batch(spark, str(inbox), dimensions(spark), layout, run_id="1", options=options)
    assert result.accepted == 2
    assert read_store(spark, layout.manifest, MANIFEST).where(f"status = '{IGNORED}'").isEmpty()


@pytest.mark.parametrize("location, want", [("file:/a", "file"), ("hdfs://h/a:b", "hdfs"), ("/a:b", ""), ("a/b:c", "")])
def test_scheme(location, want):
    assert stores.scheme(location) == want
