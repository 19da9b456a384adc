"""Operators on documents against plain Python, over nulls, empty and long texts, ties, copies, clashing columns and empty tables."""

import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from helpers import LOWER, SPACE, edge_documents, frame, lorem, sha256, words
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallymart.llm import decontaminate, jaccard, line_dedup, packing, quality_gam, quality_rules, scan, substring_dedup, suffix_dedup
from tallymart.llm.components import components
from tallymart.llm.shared import KEY, NO_ID, id_back

FIRST = lambda i: -(2**63) if i is None else i  # noqa: E731  null ids come first


def by_id(df, *columns):
    """Rows as sorted tuples, ids first."""
    return sorted((tuple(r) for r in df.select(id_back() if KEY in df.columns else "doc_id", *columns).collect()), key=repr)


def expected(rows):
    return sorted(rows, key=repr)


# -- line dedup ------------------------------------------------------------------------------------------------------------------


def clean_lines(rows):
    key = lambda x: x.strip(SPACE).translate(LOWER)
    n, last = Counter(), {}
    for i, t in rows:
        for k in {key(x) for x in (t or "").split("\n")}:
            if len(k) >= 20:
                n[k] += 1
                last[k] = max(last.get(k, FIRST(None)), FIRST(i))
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if not (n[key(x)] >= 3 and last[key(x)] != FIRST(i))]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def test_line_dedup(edge, nothing):
    assert by_id(line_dedup.dedup_lines(edge), "n_lines", "n_dropped", "kept") == expected(clean_lines(edge_documents()))
    assert line_dedup.dedup_lines(nothing).count() == 0
    assert line_dedup.without_repeated_lines(edge).columns == edge.columns


def test_rows_that_share_an_id_are_documents(spark, tmp_path):
    """Each row counts as a document, in the code as in its SQL."""
    import duckdb
    from helpers import save

    said = "A line that is long enough"
    rows = [(1, said), (1, said + "\nx"), (2, said + "\ny"), (3, None), (3, None), (4, "only twice, a long line"), (4, "only twice, a long line")]
    save(frame(spark, rows), tmp_path, "documents")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    want = con.execute(line_dedup.SQL["op3_line_dedup"]).fetchall()
    got = line_dedup.op3_line_dedup(spark, str(tmp_path)).select("doc_id", "n_lines", "n_dropped", "kept_sha256")
    assert sorted(map(tuple, got.collect())) == sorted(want)
    assert sorted(r[2] for r in want if r[0] < 3) == [0, 1, 1]


def test_index_forgets_deleted_documents(spark, edge):
    index = line_dedup.LineIndex(spark, shards=8).insert(edge)
    more = frame(spark, [(90, "This line stands in many documents."), (91, "Only here, but thrice in all.\nx"), (92, "only HERE, but thrice in all."), (93, " Only here, but thrice in all.")])
    both = index.insert(more)
    assert both.clean(more).where("n_dropped > 0").count() == 2
    back = both.delete(more, left=edge)
    table = lambda x: sorted(map(tuple, x.counts().collect()))
    assert table(back) == table(index)
    assert by_id(back.clean(edge), "n_dropped", "kept") == by_id(index.clean(edge), "n_dropped", "kept")
    # A key that has left is in no filter any more, but for chance.
    assert back.clean(more).where("n_dropped > 0").count() <= 1


@given(st.sets(st.integers(0, 2**63), max_size=300))
@settings(max_examples=30, deadline=None)
def test_cuckoo_filter_keeps_and_forgets(keys):
    h1 = scan.mix(np.array(sorted(keys), np.uint64))
    h2 = scan.mix(h1 + np.uint64(1))
    cuckoo = line_dedup.CuckooFilter.sized(2 * len(h1) + 8)
    assert cuckoo.insert(h1, h2)
    assert line_dedup.CuckooFilter.of_bytes(cuckoo.to_bytes()).contains(h1, h2).all()
    cuckoo.delete(h1, h2)
    assert not cuckoo.cells.any()


# -- substring and suffix dedup --------------------------------------------------------------------------------------------------


def clean_windows(rows, length):
    least = {}
    for i, t in rows:
        w = words(t)
        for k in range(len(w) - length + 1):
            x = tuple(w[k : k + length])
            least[x] = min(least.get(x, FIRST(i)), FIRST(i))
    out = []
    for i, t in rows:
        w = words(t)
        gone = [False] * len(w)
        for k in range(len(w) - length + 1):
            if least[tuple(w[k : k + length])] < FIRST(i):
                gone[k : k + length] = [True] * length
        out.append((i, len(w), sum(gone), " ".join(x for x, g in zip(w, gone, strict=True) if not g)))
    return out


@pytest.mark.parametrize(("length", "seed"), [(50, 10), (8, 3), (3, 1)])
def test_substring_dedup(edge, length, seed):
    got = by_id(substring_dedup.dedup_substrings(edge, length, seed), "n_words", "n_removed", "kept")
    assert got == expected(clean_windows(edge_documents(), length))


def clean_bytes(rows, length):
    least, out = {}, []
    for i, t in sorted(rows, key=lambda r: FIRST(r[0])):
        b = (t or "").encode()
        gone, own = [False] * len(b), set()
        for k in range(len(b) - length + 1):
            x = b[k : k + length]
            if x in own or least.setdefault(x, FIRST(i)) < FIRST(i):
                gone[k : k + length] = [True] * length
            own.add(x)
        spans = sum(g and (k == 0 or not gone[k - 1]) for k, g in enumerate(gone))
        out.append((i, len(b), sum(gone), spans, bytes(x for x, g in zip(b, gone, strict=True) if not g)))
    return out


@pytest.mark.parametrize("length", [100, 10, 7])
def test_suffix_dedup(edge, length):
    df = suffix_dedup.dedup_bytes(edge, length).withColumn("n_spans", F.size("spans"))
    got = sorted(((*r[:4], bytes(r[4])) for r in by_id(df, "n_bytes", "n_removed", "n_spans", "kept")), key=repr)
    assert got == expected(clean_bytes(edge_documents(), length))


def test_repeats_of_an_empty_table(nothing):
    assert substring_dedup.dedup_substrings(nothing).count() == 0
    assert suffix_dedup.dedup_bytes(nothing).count() == 0


def test_a_border_through_a_seed_changes_nothing(monkeypatch):
    """Rows of regions judged in parts of any size give the same repeats, once their single windows are compared."""
    from tallymart.llm import matches

    rng = np.random.default_rng(1)
    rows = np.array(sorted({tuple(r) for r in rng.integers(0, [4, 6, 9], (300, 3))}), np.int64)

    def outcome(parts):
        done = []
        for p in parts:
            columns = [np.ascontiguousarray(p[:, k]) for k in range(3)]
            b = scan.batch(matches.ROWS, *columns, np.zeros(len(p), np.int64), np.zeros(len(p), np.int32))
            done += [tuple(r.values()) for x in matches._settle_regions(iter([b])) for r in x.to_pylist()]
        return done

    least = {}
    for s, k, d in rows.tolist():
        least[s, k] = min(least.get((s, k), d), d)
    for cuts in ([], [150], [3, 4, 90, 200], list(range(0, len(rows), 7))):
        done = outcome([p for p in np.split(rows, cuts) if len(p)])
        repeats = {(r[0], r[1], r[2]) for r in done if r[4] == matches.REPEAT}
        single = {(r[0], r[1], r[2]) for r in done if r[4] == matches.SINGLE}
        for s, k, d in rows.tolist():
            if (s, k, d) in repeats:
                assert least[s, k] < d
            elif least[s, k] < d:
                assert (s, k, d) in single
        several = {s for s in set(rows[:, 0].tolist()) if len({v for (x, _), v in least.items() if x == s}) > 1}
        # Every class whose windows may be elsewhere under the same seed offers its smallest row.
        assert {(s, k, d) for (s, k), d in least.items() if s in several} <= single


# -- Jaccard join ----------------------------------------------------------------------------------------------------------------


def shingles(text, n=5):
    w = words((text or "").translate(LOWER))
    return {tuple(w[k : k + n]) for k in range(max(1, len(w) - n + 1))} if w else set()


def groups(rows, percent=80):
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            same = len(sets[a] & sets[b])
            if same and 100 * same >= percent * (len(sets[a]) + len(sets[b]) - same):
                root[find(a)] = find(b)
    least = defaultdict(lambda: 2**63)
    for k, (i, _) in enumerate(rows):
        least[find(k)] = min(least[find(k)], FIRST(i))
    return [(i, len(sets[k]), least[find(k)]) for k, (i, _) in enumerate(rows)]


def near_copies(seed, n, changes):
    """Copies of one text, each with words changed here and there, so that some pairs link and some do not."""
    base = lorem(seed, 150)
    out = []
    for k in range(n):
        w = list(base)
        for c in range(changes):
            w[(k * 37 + c * 53) % 150] = f"w{k}x{c}"
        out.append((1000 * seed + k, " ".join(w)))
    return out


def test_jaccard_join(edge, nothing):
    got = by_id(jaccard.similar(edge).rows, "n_shingles", "component")
    assert got == expected(groups(edge_documents()))
    assert jaccard.similar(nothing).rows.count() == 0


def test_jaccard_join_of_families(spark):
    passage = lorem(77, 40)
    rows = [r for s, c in ((11, 1), (12, 2), (13, 4), (14, 6)) for r in near_copies(s, 40, c)]
    rows += [(5000 + k, " ".join(lorem(100 + k, 60 + k) + passage)) for k in range(60)]
    got = by_id(jaccard.similar(frame(spark, rows)).rows, "n_shingles", "component")
    assert got == expected(groups(rows))


def test_jaccard_join_lists_every_link(spark, nothing):
    rows = [r for s, n, c in ((11, 90, 1), (12, 40, 3), (13, 40, 4), (14, 30, 6)) for r in near_copies(s, n, c)]
    copies = [(9000 + k, rows[k][1]) for k in range(0, len(rows), 20)]
    sets = {i: shingles(t) for i, t in rows + copies}
    want = set()
    for a in sets:
        for b in sets:
            same = len(sets[a] & sets[b]) if a < b else 0
            if same and 100 * same >= 80 * (len(sets[a]) + len(sets[b]) - same):
                want.add((a, b))
    found = jaccard.similar(frame(spark, rows + copies))
    members = defaultdict(list)
    for r in found.rows.collect():
        members[r.cid].append(r[KEY])
    classes = [(r.a, r.b) for r in found.links.collect()]
    assert len(set(classes)) == len(classes) and all(a < b for a, b in classes)
    # Rows of one class link, and rows of two classes where these do.
    got = [(x, y) for a, b in [*classes, *((c, c) for c in members)] for x in members[a] for y in members[b] if a != b or x < y]
    assert sorted((min(p), max(p)) for p in got) == sorted(want)
    assert jaccard.similar(nothing).links.count() == 0


def test_jaccard_join_components_alone(spark):
    rows = [r for s, c in ((11, 1), (12, 2), (13, 4), (14, 6)) for r in near_copies(s, 40, c)]
    found = jaccard.similar(frame(spark, rows), every_link=False)
    assert found.links is None
    assert by_id(found.rows, "n_shingles", "component") == expected(groups(rows))


def test_one_of_each_group(edge):
    left = jaccard.one_of_each_group(edge)
    assert left.columns == edge.columns
    ids = [r.doc_id for r in left.collect()]
    assert 4 not in ids and 5 not in ids and 3 not in ids  # the null id is the smallest
    assert {0, 1, 2, 6, 14} <= set(ids) and ids.count(None) == 2


@given(st.lists(st.tuples(st.integers(0, 40), st.integers(0, 400)), min_size=2, max_size=60), st.integers(2, 60))
@settings(max_examples=40, deadline=None)
def test_tree_join_loses_no_link(picks, spread):
    """Random sets around a few centres: every linked pair of different components is among the candidates."""
    sets = []
    for centre, shift in picks:
        sets.append(np.unique(scan.mix(np.arange(centre % 4 * 1000 + shift % spread, centre % 4 * 1000 + shift % spread + 80 + centre, dtype=np.uint64))))
    n = np.array([len(s) for s in sets])
    bits = []
    for s in sets:
        flat = np.zeros(int(jaccard._width(np.array([len(s)]))[0]), np.uint8)
        flat[(s & np.uint64(len(flat) - 1)).astype(np.int64)] = 1
        bits.append(np.packbits(flat).tobytes())
    bucket = jaccard.Group(np.arange(len(sets)), n, np.zeros(len(sets), np.int64), np.arange(len(sets)), bits)
    found = {(min(a, b), max(a, b)) for x, y in jaccard.tree_join(bucket, 80) for a, b in zip(x.tolist(), y.tolist(), strict=True)}
    for a in range(len(sets)):
        for b in range(a + 1, len(sets)):
            same = len(np.intersect1d(sets[a], sets[b]))
            if 100 * same >= 80 * (n[a] + n[b] - same):
                assert (a, b) in found


def test_components_end_where_each_task_holds_few_links(spark, monkeypatch):
    import tallymart.llm.components as module

    rounds = []

    def counted(df, name, write=module.stored):
        rounds.append(name)
        assert len(rounds) < 20
        return write(df, name)

    monkeypatch.setattr(module, "stored", counted)
    few = {"spark.sql.shuffle.partitions": "16", "spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.files.openCostInBytes": str(1 << 27)}
    before = {k: spark.conf.get(k) for k in few}
    try:
        for k, v in few.items():
            spark.conf.set(k, v)
        links = spark.range(199).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b")).repartition(16, "b")
        got = {r.node: r.root for r in components(links).collect()}
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert got == dict.fromkeys(range(1, 200), 0)


def test_components_of_a_long_chain(spark):
    n = 3000
    links = spark.range(n - 1).select((F.col("id") * 7919 % n).alias("a"), ((F.col("id") + 1) * 7919 % n).alias("b")).repartition(5)
    other = spark.createDataFrame([(n + 5, n + 9), (n + 9, n + 7), (n + 1, n + 1)], "a long, b long")
    got = {r.node: r.root for r in components(links.unionByName(other)).collect()}
    assert got == {**dict.fromkeys(range(1, n), 0), n + 7: n + 5, n + 9: n + 5}


# -- decontamination -------------------------------------------------------------------------------------------------------------


def judged(rows, items):
    cut = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(LOWER))
    windows = defaultdict(set)
    for i, t in items:
        w = cut(t)
        n = min(13, len(w))
        for k in range(len(w) - n + 1 if w else 0):
            windows[tuple(w[k : k + n])].add("null" if i is None else str(i))
    out = []
    for i, t in rows:
        w = cut(t)
        hit, found = set(), set()
        for n in {len(x) for x in windows}:
            for k in range(len(w) - n + 1):
                if (x := tuple(w[k : k + n])) in windows:
                    hit |= set(range(k, k + n))
                    found |= windows[x]
        out.append((i, len(w), len(hit), sorted(found), bool(hit) and 20 * len(hit) >= len(w)))
    return out


ITEMS = [(1, " ".join(lorem(1, 120)[20:50])), (2, "Short"), (10, "one two"), (3, None), (4, "..."), (5, " ".join(lorem(5, 4000)[500:513])), (5, "nowhere to be found"), (None, " ".join(lorem(3, 70)[:14]))]


def test_decontamination(spark, edge, nothing):
    items = frame(spark, ITEMS, "item_id")
    found = decontaminate.contamination(edge, items)
    got = sorted(((*r[:3], list(r[3]), r[4]) for r in by_id(found.documents, "n_words", "n_hit", "items", "contaminated")), key=repr)
    assert got == expected(judged(edge_documents(), ITEMS))
    assert decontaminate.contamination(nothing, items).documents.count() == 0
    empty = decontaminate.contamination(edge, frame(spark, [], "item_id")).documents
    assert empty.count() == len(edge_documents()) and empty.where("contaminated").count() == 0


def test_decontamination_without_broadcasts(spark, edge, monkeypatch):
    items = frame(spark, ITEMS, "item_id")
    want = by_id(decontaminate.contamination(edge, items).documents, "n_hit", "contaminated")
    monkeypatch.setattr(decontaminate, "BROADCAST_ROWS", 0)
    assert by_id(decontaminate.contamination(edge, items).documents, "n_hit", "contaminated") == want
    clean = decontaminate.clean_documents(edge, items)
    assert clean.columns == edge.columns and clean.count() == sum(1 for r in want if not r[2])


def test_tokens_are_shuffled_without_their_words(spark, edge, monkeypatch):
    monkeypatch.setattr(decontaminate, "BROADCAST_ROWS", 0)
    kept, seen = decontaminate.stored, {}
    monkeypatch.setattr(decontaminate, "stored", lambda df, name: seen.setdefault(name, df) and kept(df, name))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        decontaminate.contamination(edge, frame(spark, ITEMS, "item_id"))
        lines = seen["op7-hits"]._jdf.queryExecution().executedPlan().toString().splitlines()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    below = [lines[k + 1] for k, line in enumerate(lines) if "Exchange hashpartitioning(token" in line]
    assert below and not any(re.search(r"(\[|, )words#\d+(,|\])", line) for line in below)


# -- texts longer than a slice ---------------------------------------------------------------------------------------------------


def test_texts_longer_than_a_slice(spark):
    long = " ".join(lorem(11, 300_000))
    assert len(long) > scan.SLICE_BYTES
    tail = " ".join(lorem(12, 400))
    rows = [(1, long), (2, long + " " + tail), (3, None), (4, tail + "\nshort")]
    df = frame(spark, rows)
    n, m = len(words(long)), len(words(tail))
    assert by_id(substring_dedup.dedup_substrings(df), "n_words", "n_removed") == [(1, n, 0), (2, n + m, n), (3, 0, 0), (4, m + 1, m)]
    sizes = {i: len((t or "").encode()) for i, t in rows}
    gone = dict(by_id(suffix_dedup.dedup_bytes(df), "n_removed"))
    assert gone[2] >= sizes[1] and gone[4] >= sizes[4] - len("\nshort") and gone[3] == 0
    assert [r[1] for r in by_id(jaccard.similar(df).rows, "component")] == [1, 1, 3, 4]
    item = " ".join(words(long.translate(LOWER))[-40:-20])
    hit = decontaminate.contamination(df, frame(spark, [(7, item)], "item_id")).documents
    assert [(r[0], r[2]) for r in by_id(hit, "n_words", "n_hit")] == [(1, 20), (2, 20), (3, 0), (4, 0)]
    lines = frame(spark, [(k, long + "\nx") for k in range(3)])
    assert [r[1:] for r in by_id(line_dedup.dedup_lines(lines), "n_lines", "n_dropped")] == [(2, 1), (2, 1), (2, 0)]


# -- packing ---------------------------------------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def vocabulary():
    return pytest.importorskip("public_tokenizers").path("byte_bpe_50k.json")


@pytest.mark.parametrize(("size", "open_bins"), [(1024, 4096), (64, 3)])
def test_packing(edge, vocabulary, size, open_bins):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(vocabulary)
    rows = packing.pack(edge, vocabulary, 2, size, open_bins, with_ids=True).select(id_back(), "_f", "piece", "start", "length", "ids_crc32", "sequence_id", "offset", "ids").collect()
    texts, bins = defaultdict(list), defaultdict(list)
    for r in rows:
        texts[r.doc_id, r["_f"]].append(r)
        bins[r.sequence_id].append((r.offset, r.length))
    got = Counter()
    for (i, _), pieces in texts.items():
        pieces.sort(key=lambda r: r.piece)
        copies = sum(r.piece == 0 for r in pieces)
        assert [r.piece for r in pieces] == [k for k in range(len(pieces) // copies) for _ in range(copies)]
        pieces = pieces[::copies]
        assert [r.length for r in pieces[1:]] == [size] * (len(pieces) - 1)
        ids, at = [], 0
        for r in pieces:
            assert r.start == at and r.length == len(r.ids) and zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32
            ids, at = ids + r.ids, at + r.length
        got[i, tuple(ids)] += copies
    assert got == Counter((i, (*tokenizer.encode(t or "", add_special_tokens=False).ids, 2)) for i, t in edge_documents())
    for places in bins.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= size
    # With many open bins it is about as tight as laying the longest first, with all bins open.
    fills = []
    for length in sorted((r.length for r in rows), reverse=True):
        fits = next((k for k, f in enumerate(fills) if f + length <= size), None)
        if fits is None:
            fills.append(length)
        else:
            fills[fits] += length
    assert sum(r.length for r in rows) <= size * len(bins)
    assert len(bins) <= len(fills) + (2 if open_bins > 100 else len(fills) // 4)


def test_packing_of_an_empty_table(nothing, vocabulary):
    assert packing.pack(nothing, vocabulary, 2).count() == 0


@given(st.lists(st.integers(1, 50), max_size=300), st.integers(1, 20))
@settings(max_examples=50, deadline=None)
def test_best_fit_keeps_its_bounds(lengths, open_bins):
    packer, fill = packing.BestFit(50, open_bins), Counter()
    for n in lengths:
        bin_, place = packer.put(n)
        assert place == fill[bin_]
        fill[bin_] += n
        assert fill[bin_] <= 50 and len(packer.left()) == packer.opened <= open_bins
    assert {b: f for b, f in packer.left()}.items() <= fill.items()


@given(st.lists(st.text(alphabet=st.sampled_from(list("ab 's\n\t\r.1  \x1c\x85é日")), max_size=40), min_size=1, max_size=8))
@settings(max_examples=60, deadline=None)
def test_encoder_equals_whole_texts(texts):
    public = pytest.importorskip("public_tokenizers")
    encoder = packing.encoder_of(public.path("byte_bpe_50k.json"))
    for _, _, s in scan.slices(pa.array(texts)):
        ids, first = encoder.encode(s)
        for k, t in enumerate(texts):
            assert ids[first[k] : first[k + 1]].tolist() == encoder.tokenizer.encode(t, add_special_tokens=False).ids


# -- quality ---------------------------------------------------------------------------------------------------------------------


def counts(text):
    text = text or ""
    w = words(text)
    windows = Counter(tuple(w[k : k + 8]) for k in range(len(w) - 7))
    repeat = set()
    for k in range(len(w) - 7):
        if windows[tuple(w[k : k + 8])] > 1:
            repeat |= set(range(k, k + 8))
    lines = [x for x in text.split("\n") if words(x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(repeat)


def test_quality_counts(edge, nothing):
    got = by_id(quality_rules.judge(edge), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    assert got == expected([(i, *counts(t)) for i, t in edge_documents()])
    assert quality_rules.judge(nothing).count() == 0


LINES = {
    "A plain sentence that ends as it should.": False,
    "Home | News | Sport | About | Contact": True,
    "$$$ win ### now %%% &&&": True,
    "BUY NOW AND SAVE A LOT": True,
    "(c) 2020, All Rights Reserved.": True,
    "word " * 30: True,
    "na " * 12 + ".": True,
    "Title": False,
    "": False,
}


def test_line_rules(spark):
    texts = list(LINES)
    page = quality_rules.Page(next(scan.slices(pa.array(["\n".join(texts)])))[2])
    assert quality_rules.failed_lines(page, 3, 25).tolist() == list(LINES.values())
    good = " ".join(lorem(1, 30)) + "."
    rows = frame(spark, [(1, good), (2, good + "\n" + "BUY NOW AND SAVE A LOT"), (3, "BUY NOW AND SAVE A LOT " * 3 + "\n" + " ".join(lorem(2, 8)) + ".")])
    got = {r[0]: r[1:] for r in by_id(quality_rules.judge(rows), "kept", "kept_text")}
    assert got[1] == (True, good) and got[2] == (True, good) and not got[3][0]


def test_classifier_learns_pairs():
    rng = np.random.default_rng(0)
    x = rng.random((4000, 4))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)) | (x[:, 2] > 0.9)
    model = quality_gam.Gam.fit(x[:3000], y[:3000].astype(float))
    assert ((model.score(x[3000:]) > 0.5) == y[3000:]).mean() > 0.95
    assert any({a, b} == {0, 1} for a, b, _ in model.pairs)


def test_classifier_query_separates_held_out_documents(spark):
    import __spark_entry__ as contract

    rows = contract.queries()["op2_quality_gam"](spark, "/root/testdata/sf0.01")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    seen = rows.join(labels, "doc_id").where("held_out").select("predicted", "quality").collect()
    assert len(seen) > 50 and np.mean([r.predicted == r.quality for r in seen]) >= 0.95
    assert rows.where("score IS NULL OR score < 0 OR score > 1").count() == 0
    for r in rows.limit(200).collect():
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)


def test_classifier_on_edges(spark, edge, nothing):
    labels = frame(spark, [], "doc_id", "quality").withColumn("quality", F.col("quality").cast("int"))
    model = quality_gam.train(edge, labels)
    assert quality_gam.score(edge, model).count() == len(edge_documents())
    assert quality_gam.score(nothing, model).count() == 0
    some = spark.createDataFrame([(3, 1), (5, 1), (12, 0), (8, 0), (None, 1), (6, None)], "doc_id long, quality int")
    model = quality_gam.train(edge, some)
    assert all(0 <= r.score <= 1 for r in quality_gam.score(edge, model).collect())
    assert quality_gam.good_documents(edge, some).columns == edge.columns


def test_classifier_learns_one_text_of_a_repeated_id(spark, monkeypatch):
    rows = [(1, " ".join(lorem(k, 20 + k))) for k in range(60)] + [(i, " ".join(lorem(100 + i, 50))) for i in range(2, 6)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(1, 6)], "doc_id long, quality int")
    learned = []
    monkeypatch.setattr(quality_gam.Gam, "fit", lambda x, y: learned.append((x.tolist(), y.tolist())) or quality_gam.Gam())
    for docs in (rows, rows[::-1]):
        quality_gam.train(frame(spark, docs), labels, max_rows=5)
    assert [len(y) for _, y in learned] == [5, 5] and learned[0] == learned[1]


def test_null_id_is_given_back(edge):
    assert NO_ID not in [r[0] for r in by_id(quality_rules.judge(edge), "kept")]
    assert sha256("") == "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"
