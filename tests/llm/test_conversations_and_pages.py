"""Quotation linking against its SQL on small conversations, and archives against a round trip."""

import gzip
import hashlib

import duckdb
import pytest
from helpers import frame, save

from tallymart.llm import quotation, warc

TALK = [
    (1, 0, "user", "Hello there friend.\nHow are you today?\n\nSecond paragraph here\nwith two lines."),
    (1, 1, "assistant", "> Hello there   friend.\n> How are YOU today?\nI am fine.\n\nThanks."),
    (1, 2, "user", "Unquoted line.\nmore"),
    (1, 3, "assistant", "On Monday, X wrote:\n>> How are you today?\n> I am fine.\nGreat to hear"),
    (1, 4, "user", "> Second paragraph here\n> something changed\n> with two lines.\nok\n\n"),
    (1, 5, "user", "after that"),
    (1, 6, "user", ">Great to hear\nyes"),
    (1, 7, "user", "> nothing known\nhmm > not a quote"),
    (1, 7, "user", "> after that\nhmm"),
    (2, 0, "user", None),
    (2, 1, "user", ""),
    (2, 2, "user", ">"),
    (2, 3, "user", "> a\r\nb\r\n"),
    (2, 4, None, "plain"),
    (3, 0, "user", "a"),
    (3, 5, "user", "> a"),
    (3, 9, "user", "> a\n> b"),
    (3, 11, "x", ">> a\n\n> b"),
    *[(4, k, "user", f"> message {k - 1}\nmessage {k}") for k in range(40)],
    *[(6, k, "user", "> Unquoted line.\n> more words\nyes") for k in (1, 1, 1, 2)],
    *[(6, 0, "user", "Unquoted line.\nmore words\nthird")] * 2,
    (6, 1, "user", "> Unquoted line.\n>> third\n> Unquoted line.\nyes"),
    (6, 3, "user", "Unquoted line."),
    *[(6, 4, "user", "> unquoted LINE.\nUnquoted line.")] * 2,
    *[(5, k, "user", f"line {k}\n" + "".join(f"{'>' * d} line {k - d}\n" for d in range(1, min(k, 9) + 1))) for k in range(0, 5000, 250)],
]


@pytest.fixture(scope="module")
def talk(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("talk"))
    save(spark.createDataFrame(TALK, "conv_id long, turn long, role string, text string"), folder, "conversations")
    return folder


def comparable(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(str(r[i]) for i in order) for r in rows)


def test_repeated_rows_are_linked_once(spark):
    """A message that quotes two lines, given twice, has one link for both rows; passages begin where they do in one row."""
    rows = [(1, 0, "user", "one line\n\nother line")] + [(1, 1, "user", "> one line\nyes\n> other line")] * 2
    found = quotation.link_quotations(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    assert [r.linked for r in found.messages.where("turn = 1").collect()] == [2, 2]
    assert sorted((r.start, r.source) for r in found.links.collect()) == [(0, 0), (2, 0)]


@pytest.mark.parametrize("stretch", [1, 7, 1024])
def test_a_line_that_all_turns_quote(spark, monkeypatch, stretch):
    """Each passage gets its last source, with a row for each quote and message, not for each pair of them."""
    rows = [(1, k, "user", "> the same line\nthe same line") for k in range(2000)]
    mixed = spark.createDataFrame(rows, "conv long, turn long, role string, text string").selectExpr("*", "xxhash64(role, text) AS mid")
    kept, seen = quotation.stored, {}

    def spy(df, name):
        out = kept(df, name)
        seen[name] = out.count()
        return out

    monkeypatch.setattr(quotation, "stored", spy)
    found = quotation._links(mixed, stretch)
    assert {(r.turn, r.source) for r in found.collect()} == {(k, k - 1) for k in range(1, 2000)}
    assert seen == {"op1-passages": 2000, "op1-units": 6000, "op1-whole": 1999}


@pytest.mark.parametrize("clash", [["_k", "line", "hash", "source", "part", "kind", "passage"]])
def test_quotation_with_clashing_columns(spark, talk, clash):
    df = spark.read.parquet(f"{talk}/conversations.parquet")
    more = df.selectExpr("*", *[f"'x' AS {c}" for c in clash])
    both = [sorted(map(str, quotation.link_quotations(x).messages.collect())) for x in (df, more)]
    assert both[0] == both[1]


def test_quotation_equals_sql(spark, talk):
    got = quotation.op1_quotation(spark, talk)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{talk}/conversations.parquet/*.parquet')")
    want = con.execute(quotation.SQL["op1_quotation"])
    assert comparable(got.columns, map(tuple, got.collect())) == comparable([c[0] for c in want.description], want.fetchall())


def test_quotation_links(spark, talk):
    found = quotation.link_quotations(spark.read.parquet(f"{talk}/conversations.parquet"), stretch=3)
    rows = {(r.conv_id, r.turn, r.body): r for r in found.messages.collect()}
    assert rows[1, 1, "I am fine.\n\nThanks."].parent_turn == 0
    assert rows[1, 3, "Great to hear"].reply_path == [0, 1, 1, 3, 3]  # after message 1, before message 2
    assert rows[1, 4, "ok"].parent_turn == 0  # by two of three lines
    assert rows[4, 39, "message 39"].reply_path[:4] == [0, 1, 1, 2] and len(rows[4, 39, "message 39"].reply_path) == 79
    links = {(r.conv, r.turn, r.level): r.source for r in found.links.collect()}
    assert links[1, 3, 2] == 0 and links[1, 3, 1] == 1


def test_quotation_of_nulls_and_nothing(spark):
    none = spark.createDataFrame([(None, None, None, None), (None, 1, "user", "> x"), (None, None, "user", "x")], "conv_id long, turn long, role string, text string")
    rows = quotation.link_quotations(none).messages.collect()
    assert len(rows) == 3 and all(r.conv_id is None for r in rows)
    assert quotation.link_quotations(none.limit(0)).messages.count() == 0


# -- archives --------------------------------------------------------------------------------------------------------------------

BIG = "<html>" + "é" * 600 + "</html>"
PAGES = [
    (1, "http://a.example/", BIG),
    (2, "http://b.example/a b\r\nX: y", BIG),
    (3, None, "small"),
    (4, "http://c.example/", "small"),
    (5, "http://d.example/", None),
    (6, "", "\r\n\r\nWARC/1.1\r\n\r\n"),
    (9, "http://e.example/", BIG),
    (9, "http://e.example/", BIG),
    (None, "http://f.example/", BIG),
    *[(k, f"http://g.example/{k}", f"<p>{hashlib.sha256(str(k).encode()).hexdigest() * (k % 40)}</p>") for k in range(100, 200)],
]


@pytest.fixture(scope="module")
def pages(spark):
    rows = [(i, u, h, "x") for i, u, h in PAGES]
    return spark.createDataFrame(rows, "page_id long, url string, html string, page string")


def expected_records():
    digest = lambda h: hashlib.sha1((h or "").encode()).hexdigest()
    out = []
    for i, _, h in PAGES:
        size = len((h or "").encode())
        same = [j for j, _, g in PAGES if g == h and j is not None]
        last = max(same) if same and size >= 1000 else None
        refers = last if last is not None and (i is None or i < last) else None
        out.append((i, size, digest(h), "response" if refers is None else "revisit", refers))
    return sorted(out, key=repr)


def test_archives_round_trip(spark, pages, tmp_path):
    manifest = warc.write_archives(pages, str(tmp_path), roll_bytes=4000).collect()
    assert len(manifest) > 3 and all(abs(r.bytes - 4000) < 3000 for r in manifest[:-1])
    back = warc.read_archives(spark, str(tmp_path))
    got = [tuple(r) for r in back.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()]
    assert sorted(got, key=repr) == expected_records()
    texts = {r.page_id: r.payload for r in back.where("record_type = 'response'").collect()}
    assert texts[6] == PAGES[5][2] and texts[9] == BIG and texts[5] == ""


def test_archives_do_not_depend_on_partitions(spark, pages, tmp_path):
    def files(name, df):
        base = tmp_path / name
        warc.write_archives(df, str(base), roll_bytes=4000)
        return {p.name: p.read_bytes() for p in base.glob("*.warc.gz")}

    one, other = files("one", pages.coalesce(1)), files("other", pages.orderBy("url").repartition(7))
    assert one == other and len(one) > 3
    whole = b"".join(gzip.decompress(one[k]) for k in sorted(one))
    ids = [line for line in whole.split(b"\r\n") if line.startswith(b"WARC-Record-ID: <urn:x-page:")]
    assert ids == sorted(ids, key=lambda x: int(x.rpartition(b":")[2][:-1]))
    assert b"\r\nX: y" not in whole


def expected_archives(df, roll_bytes):
    """Page ids by file, by one pass over the records in order: an archive begins with the first record behind each full roll_bytes."""
    rows = warc.referred(df.select("page_id", "url", "html")).collect()
    rows = sorted(((r.page, r.print), len(warc.member(warc.record(r.page, r.url, (r.html or "").encode(), r.refers)))) for r in rows)
    at, fill, firsts = 0, -1, []
    for key, size in rows:
        if at // roll_bytes > fill:
            fill = at // roll_bytes
            firsts.append(key)
        at += size
    out = {}
    for key, _ in rows:
        out.setdefault(warc.name_of(sum(first <= key for first in firsts) - 1), []).append(key[0])
    return out


@pytest.mark.parametrize("lots", [1, 3, warc.LOTS])
@pytest.mark.parametrize("roll_bytes", [900, 4000])
def test_archives_do_not_depend_on_lots(spark, pages, tmp_path, lots, roll_bytes):
    repeated = pages.union(pages.where("page_id in (3, 120)")).union(pages.where("page_id = 139").crossJoin(spark.range(9)).drop("id"))
    manifest = warc.write_archives(repeated.repartition(5), str(tmp_path), roll_bytes=roll_bytes, lots=lots)
    want = expected_archives(repeated, roll_bytes)
    assert {r.file: r.records for r in manifest.collect()} == {k: len(v) for k, v in want.items()}
    for file, ids in want.items():
        data = (tmp_path / file).read_bytes()
        assert [r["page_id"] for r in warc.parse(data)] == [None if i == warc.NO_ID else i for i in ids]


def test_only_the_first_records_of_lots_reach_the_driver(spark, pages, tmp_path, monkeypatch):
    taken = []
    dealt = warc._dealt
    monkeypatch.setattr(warc, "_dealt", lambda *edges: (taken.append(len(edges[0])), dealt(*edges))[1])
    assert warc.write_archives(pages, str(tmp_path), roll_bytes=900, lots=4).count() > 8
    assert len(taken) == 1 and taken[0] <= 4


def test_damaged_or_uncommitted_archives(spark, pages, tmp_path):
    manifest = warc.write_archives(pages, str(tmp_path), roll_bytes=4000)
    (tmp_path / "pages-99999999.warc.gz").write_bytes(b"left by a dead run")
    assert warc.read_archives(spark, str(tmp_path)).count() == len(PAGES)
    first = tmp_path / manifest.first().file
    first.write_bytes(first.read_bytes()[:-1])
    with pytest.raises(Exception, match="manifest"):
        warc.read_archives(spark, str(tmp_path)).count()


def test_no_pages(spark, pages, tmp_path):
    assert warc.write_archives(pages.limit(0), str(tmp_path)).count() == 0
    save(frame(spark, [], "page_id", "html").selectExpr("page_id", "'' AS url", "html"), str(tmp_path), "pages")
    assert warc.op6_warc(spark, str(tmp_path)).count() == 0
