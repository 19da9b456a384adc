import gzip
import shutil
from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from fixtures import HEADER, rows, sale, write_csv
from tallymart.schemas import SALES_FACT, UNPARSED
from tallymart.sources import files, sales


def verdicts(spark, inbox):
    return {r.file_location.split("/inbox/")[1]: r for r in files.manifest(spark, str(inbox)).collect()}


def test_manifest_judges_every_file(spark, tmp_path):
    inbox = tmp_path / "inbox"
    write_csv(inbox / "happy.csv", HEADER, [sale(1, 121, 1, "2023-03-04", 50)])
    write_csv(inbox / "sub" / "happy.csv", [*HEADER, "payment_mode"], [[*sale(1, 121, 1, "2023-03-04", 50), "cash"]])
    write_csv(inbox / "missing.csv", [c for c in HEADER if c != "store_id"], [])
    write_csv(inbox / "case.csv", [c.upper() if c == "price" else c for c in HEADER], [])
    write_csv(inbox / "header only.csv", HEADER, [])
    write_csv(inbox / "odd [1].csv", HEADER, [sale(2, 121, 1, "2023-03-04", 50)])
    (inbox / "notes.txt").write_text("hello\n")
    (inbox / "blank.csv").write_text("\n \n")
    (inbox / "empty.csv").write_text("")
    (inbox / "late header.csv").write_text("\n\n" + ",".join(HEADER) + "\n")
    got = verdicts(spark, inbox)
    assert {k for k, r in got.items() if r.status == "accepted"} == {
        "happy.csv", "sub/happy.csv", "header only.csv", "odd [1].csv", "late header.csv",
    }
    assert got["missing.csv"].missing_columns == ["store_id"]
    assert got["missing.csv"].reason == "missing store_id"
    assert got["case.csv"].missing_columns == ["price"]
    assert got["notes.txt"].reason == "not a .csv file"
    assert got["blank.csv"].reason == "no header"
    assert "empty.csv" not in got
    assert got["sub/happy.csv"].header == [*HEADER, "payment_mode"]


def test_headers_of_split_and_compressed_files(spark, tmp_path):
    inbox = tmp_path / "inbox"
    write_csv(inbox / "big.csv", HEADER, [sale(1, 121, 1, "2023-03-04", 50)] * 20000)
    write_csv(inbox / "other.csv", ["x", *HEADER], [[7, *sale(1, 121, 1, "2023-03-04", 50)]] * 20000)
    with (inbox / "big.csv").open("rb") as src, gzip.open(inbox / "z.csv.gz", "wb") as dst:
        shutil.copyfileobj(src, dst)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "65536")
    try:
        got = verdicts(spark, inbox)
        assert files.header_lines(spark, str(inbox), [str(inbox / "big.csv")]).count() == 1
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert got["big.csv"].header == HEADER
    assert got["other.csv"].header == ["x", *HEADER]
    assert got["z.csv.gz"].reason == "not a .csv file"


@pytest.mark.parametrize("small", [0, 200, 1 << 20])
def test_header_pass_needs_neither_sort_nor_shuffle(spark, tmp_path, small):
    inbox = tmp_path / "inbox"
    for i in range(40):
        write_csv(inbox / f"part {i}.csv", [*HEADER, f"extra{i}"], [[*sale(1, 121, 1, "2023-03-04", 50), i]] * i)
    df = files.header_lines(spark, str(inbox), small=small)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Sort" not in plan
    assert sorted(r.header_line for r in df.collect()) == sorted(",".join([*HEADER, f"extra{i}"]) for i in range(40))
    names = {r.file_name for r in files.list_files(spark, str(inbox)).collect()}
    assert "part 7.csv" in names


@pytest.mark.parametrize("small", [0, 1 << 20])
def test_header_is_the_first_line_with_a_visible_character(spark, tmp_path, small):
    inbox = tmp_path / "inbox"
    inbox.mkdir()
    texts = {
        "plain": b"a,b\n1,2\n",
        "windows": b"\r\n  \r\na,b\r\n1,2\r\n",
        "old": b"a,b\r1,2\r",
        "mark": b"\xef\xbb\xbfa,b\n1,2\n",
        "indented": b"\n\t a,b \n1,2\n",
        "only": b"a,b",
        "blank": b" \n\t\n",
        "accents": "\n\u00e9t\u00e9,b\n".encode(),
    }
    for name, content in texts.items():
        (inbox / f"{name}.csv").write_bytes(content)
    got = {r.file_uri.rsplit("/", 1)[1].removesuffix(".csv"): r.header_line for r in files.header_lines(spark, str(inbox), small=small).collect()}
    assert got == {
        "plain": "a,b", "windows": "a,b", "old": "a,b", "mark": "a,b", "indented": "\t a,b ", "only": "a,b", "accents": "\u00e9t\u00e9,b",
    }
    for name, line in got.items():
        assert spark.read.option("header", True).csv(str(inbox / f"{name}.csv")).columns == line.split(","), name


def test_each_header_scan_opens_only_its_own_files(spark, tmp_path):
    inbox = tmp_path / "inbox"
    for i in range(5):
        write_csv(inbox / f"small{i}.csv", HEADER, [])
    write_csv(inbox / "large.csv", HEADER, [sale(1, 121, 1, "2023-03-04", 50)] * 1000)
    text = files._text(spark, str(inbox), None, whole=True).where(F.col("_metadata.file_size") > 10000)
    assert text.rdd.getNumPartitions() == 1
    assert text.select("_metadata.file_name").collect()[0][0] == "large.csv"
    scan = text._jdf.queryExecution().executedPlan().collectLeaves().head()
    scan.execute().count()
    assert scan.metrics().apply("numFiles").value() == 1


def test_header_names_follow_the_csv_reader(spark, tmp_path):
    lines = ['a,b', '"a, b",c', 'a,A,b,', '"say ""hi""",x', ' a,b ']
    df = spark.createDataFrame([(s,) for s in lines], "line string")
    got = {r.line: r.names for r in df.select("line", files.header_names(F.col("line")).alias("names")).collect()}
    assert got['"a, b",c'] == ["a, b", "c"]
    assert got['a,A,b,'] == ["a0", "A1", "b", "_c3"]
    assert got['"say ""hi""",x'] == ['say "hi"', "x"]
    assert got[' a,b '] == [" a", "b "]
    for i, line in enumerate(lines):
        if "hi" in line:
            continue
        path = tmp_path / f"{i}.csv"
        path.write_text(line + "\n")
        assert spark.read.option("header", True).csv(str(path)).columns == got[line]


def by_header(spark, inbox):
    grouped = {}
    for r in files.manifest(spark, str(inbox)).where("status = 'accepted'").collect():
        grouped.setdefault(tuple(r.header), []).append(r.file_location)
    return grouped


def test_extras_are_folded_in_file_order(spark, tmp_path):
    inbox = tmp_path / "inbox"
    base = sale(1, 121, 1, "2023-03-04", "1.5")
    write_csv(inbox / "a.csv", [*HEADER, "payment_mode", "coupon"], [[*base, "cash", "007"], [*base, "cash", ""], [*base, "", ""]])
    write_csv(inbox / "b.csv", ["coupon", *HEADER, "payment_mode"], [["007", *base, "cash"]])
    write_csv(inbox / "c.csv", HEADER, [base])
    write_csv(inbox / "d.csv", [*reversed(HEADER), "additional_column"], [[*reversed(base), "mine"]])
    df = sales.read_sales(spark, by_header(spark, inbox))
    got = {
        (r.source_file.rsplit("/", 1)[1], r.additional_column): r for r in df.collect()
    }
    assert set(got) == {
        ("a.csv", "cash, 007"), ("a.csv", "cash"), ("a.csv", ""), ("b.csv", "007, cash"), ("c.csv", None), ("d.csv", "mine"),
    }
    for r in got.values():
        assert (r.customer_id, r.store_id, r.sales_person_id, r.quantity) == (1, 121, 1, 1)
        assert r.sales_date == date(2023, 3, 4)
        assert r.total_cost == Decimal("1.50")
        assert r[UNPARSED] is None


def test_untypable_rows_are_set_aside_whatever_is_selected(spark, tmp_path):
    inbox = tmp_path / "inbox"
    good = sale(1, 121, 1, "2023-03-04", 50)
    bad_id = ["q", *good[1:]]
    bad_date = [*good[:3], "2023-13-45", *good[4:]]
    bad_list = [*good[:4], "[1, 2, 3]", *good[5:]]
    write_csv(inbox / "a.csv", [*HEADER, "payment_mode"], [[*r, "cash"] for r in (good, bad_id, bad_date, bad_list)] + [good[:3]])
    df = sales.read_sales(spark, by_header(spark, inbox))
    assert rows(df.where(F.col(UNPARSED).isNull()).select("total_cost")) == [(Decimal("50.00"),)]
    bad = {r[0] for r in df.where(F.col(UNPARSED).isNotNull()).select(UNPARSED, "price").collect()}
    assert bad == {
        "q,121,sugar,2023-03-04,1,50,1,50,cash",
        "1,121,sugar,2023-13-45,1,50,1,50,cash",
        '1,121,sugar,2023-03-04,"[1, 2, 3]",50,1,50,cash',
        "1,121,sugar",
    }
    assert df.count() == 5


def test_parts_of_cents_and_quotes_are_kept(spark, tmp_path):
    inbox = tmp_path / "inbox"
    good = sale(1, 121, 1, "2023-03-04", "50.10")
    write_csv(inbox / "a.csv", HEADER, [good, [*good[:-1], "0.005"], [*good[:-1], "7.500"], ["q", 121, "salt, fine", *good[3:]]])
    df = sales.read_sales(spark, by_header(spark, inbox))
    assert rows(df.where(F.col(UNPARSED).isNull()).select("total_cost")) == [(Decimal("50.10"),), (Decimal("7.50"),)]
    assert {r[0] for r in df.where(F.col(UNPARSED).isNotNull()).select(UNPARSED).collect()} == {
        "1,121,sugar,2023-03-04,1,50.10,1,0.005",
        'q,121,"salt, fine",2023-03-04,1,50.10,1,50.10',
    }


@pytest.mark.parametrize("extras", [0, 1, 20])
def test_lines_are_converted_in_generated_code(spark, tmp_path, extras):
    """A function over an array in the projection costs more than all conversions; only files with many extras pay for it."""
    more = [f"x{i}" for i in range(extras)]
    values = [None if i == 1 else i for i in range(extras)]
    at = write_csv(tmp_path / "a.csv", [*HEADER, *more], [[*sale(1, 121, 1, "2023-03-04", 5), *values]])
    df = sales.read_sales(spark, {(*HEADER, *more): [f"file:{at}"]})
    assert ("lambda" in df._jdf.queryExecution().optimizedPlan().toString()) == (extras > 16)
    assert [r.additional_column for r in df.collect()] == [", ".join(str(v) for v in values if v is not None) if extras else None]


def test_money_that_fits_in_any_spelling(spark, tmp_path):
    texts = ["1.500", "1.505", "15e-1", "15e-3", "1.5", "-1.55", "+7", ".5", "5.", "", "1234567890123456.78", "12345678901234567", "1.5 ", "1.555 ", "x"]
    at = write_csv(tmp_path / "a.csv", HEADER, [[i, 1, "p", "2023-03-04", 1, t, 1, 1] for i, t in enumerate(texts)])
    got = {r.customer_id: r for r in sales.read_sales(spark, {tuple(HEADER): [f"file:{at}"]}).collect()}
    assert [None if got[i].price is None else str(got[i].price) for i in range(len(texts))] == [
        "1.50", None, "1.50", None, "1.50", "-1.55", "7.00", "0.50", "5.00", None, "1234567890123456.78", None, "1.50", None, None,
    ]
    assert [i for i in got if got[i][UNPARSED] is not None] == [1, 3, 11, 13, 14]


def test_a_bad_row_keeps_its_line_as_it_was(spark, tmp_path):
    """Byte for byte: quotes that were not needed, blanks, escapes, a header in mid-file, too few and too many fields."""
    inbox = tmp_path / "inbox"
    inbox.mkdir()
    bad = [
        'q,121,"sugar",2023-03-04,"1",50,1,50',
        ' 1 ,121,sugar,2023-03-04,1,50,1,"5 0"',
        'q,121,"salt \\"fine\\", white",2023-03-04,1,50,1,50',
        ",".join(HEADER),
        "1,121,sugar,2023-03-04,1,50,1,50,",
        "1,121,sugar,2023-03-04,1,50,1,50,\u0001",
        "1,121,sugar,2023-03-04,1,50,1",
        "1,121,sugar,2023-03-04,1,50,\u0001",
        "\u00e9,\u0001,x",
    ]
    good = '1,121,"sugar, ""brown""",2023-03-04,1,50,1,50'
    for name, end in (("a b+c%20.csv", "\n"), ("d.csv", "\r\n")):
        (inbox / name).write_bytes(end.join([",".join(HEADER), "", *bad, good, "  "]).encode())
    df = sales.read_sales(spark, by_header(spark, inbox))
    kept = sorted(r[0] for r in df.where(F.col(UNPARSED).isNotNull()).select(UNPARSED).collect())
    assert kept == sorted(bad * 2)
    assert rows(df.where(F.col(UNPARSED).isNull()).select("customer_id", "total_cost")) == [(1, Decimal("50.00"))] * 2


def test_plans_do_not_grow_with_headers(spark, tmp_path):
    base = sale(1, 121, 1, "2023-03-04", "1.5")
    sizes = []
    for count in (1, 500):
        inbox = tmp_path / f"inbox{count}"
        inbox.mkdir()
        headers = {}
        for k in range(count):
            path = inbox / f"{k}.csv"
            # The extra's name and place differ from file to file.
            at = k % (len(HEADER) + 1)
            header = [*HEADER[:at], f"extra{k}", *HEADER[at:]]
            path.write_text("\n".join(",".join(line) for line in (header, [*map(str, base[:at]), f"v{k}", *map(str, base[at:])])) + "\n")
            headers[tuple(header)] = [str(path)]
        df = sales.read_sales(spark, headers)
        sizes.append(len(df._jdf.queryExecution().optimizedPlan().toString().splitlines()))
        got = rows(df.select("customer_id", "sales_person_id", "total_cost", "additional_column", UNPARSED))
        assert sorted(got) == sorted((1, 1, Decimal("1.50"), f"v{k}", None) for k in range(count))
    assert sizes[0] == sizes[1]


def test_wide_and_narrow_files_together(spark, tmp_path):
    base = [str(x) for x in sale(1, 121, 1, "2023-03-04", "1.5")]
    headers = {}
    for extra in (0, 5, 6, 7, 40, 300):
        path = tmp_path / f"{extra}.csv"
        header = [*[f"e{i}" for i in range(extra)], *HEADER]
        path.write_text("\n".join([",".join(header), ",".join([*["x"] * extra, *base]), ",".join([*["x"] * extra, *base, ""])]))
        headers[tuple(header)] = [str(path)]
    df = sales.read_sales(spark, headers)
    good = rows(df.where(F.col(UNPARSED).isNull()).select("additional_column"))
    assert sorted(map(str, good)) == sorted(str((", ".join(["x"] * e) if e else None,)) for e in (0, 5, 6, 7, 40, 300))
    assert df.where(F.col(UNPARSED).isNotNull()).count() == 6


def test_stacking(spark):
    a = spark.createDataFrame([(1, "x")], "a int, b string")
    b = spark.createDataFrame([("y", 2)], "b string, a int")
    c = spark.createDataFrame([(3,)], "a int")
    assert rows(sales.stack_by_name([a, b, c])) == [(1, "x"), (2, "y"), (3, None)]
    assert rows(sales.stack_by_position([a, a])) == [(1, "x"), (1, "x")]
    empty = sales.empty_sales(spark)
    assert empty.schema == SALES_FACT and empty.isEmpty()
