"""Each operator against brute force on small rows: nulls, repeats, ties, empty texts and tables, long texts."""

import hashlib
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import oracle
from rawstar.llm import decontaminate, exact, hmm, language, ledger, lines, neardup, packing, queries, warc, windows
from rawstar.llm.common import held_out, table

SF = "/root/testdata/sf0.001"
WORDS = ["alpha", "beta", "gamma", "delta", "Épsilon", "zeta", "eta", "theta", "iota", "kappa", "password=", "AKIA"]


def sentence(n, seed):
    r = random.Random(seed)
    return " ".join(r.choice(WORDS) + str(r.randint(0, 40)) for _ in range(n))


LONG = sentence(30_000, 1)
ROWS = [
    (1, sentence(60, 2)),
    (2, sentence(60, 2)),
    (3, None),
    (4, ""),
    (None, sentence(60, 2)),
    (5, "a common line of some length\nother " + sentence(30, 3)),
    (6, "  A Common LINE of some length \r\nother\n" + sentence(40, 4)),
    (7, "a common line of some length\n" + LONG),
    (8, sentence(59, 2)[:-8] + " changed"),
    (8, sentence(59, 2)[:-8] + " changed"),
    (9, "one two"),
    (10, "One\ttwo"),
    (11, "ab" * 300),
    (12, "\n\n"),
]


@pytest.mark.parametrize("name", sorted(queries.reg.oracles))
def test_matches_sql(spark, name):
    difference = oracle.compare(spark, oracle.connect(SF), queries.reg.queries[name], queries.reg.oracles[name], SF)
    assert difference is None, difference


def test_lines(documents):
    strip = " \t\n\x0b\x0c\r"
    low = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})
    keys = [[x.strip(strip).translate(low) for x in (t or "").split("\n")] for _, t in ROWS]
    want = []
    for (i, t), own in zip(ROWS, keys):
        out = []
        for line, k in zip((t or "").split("\n"), own):
            holders = {ROWS[j] for j, other in enumerate(keys) if k in other}  # a row listed twice is one document
            biggest = max((x for x, _ in holders if x is not None), default=None)
            if len(k) < 20 or len(holders) < 3 or i == biggest:
                out.append(line)
        want.append((i, len(own), len(own) - len(out), "\n".join(out)))
    for probes in (lines.PROBES, 3):
        got = lines.drop_repeated_lines(documents(ROWS), probes=probes).select("doc_id", "n_lines", "n_dropped", F.col("kept").cast("string"))
        assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, want))


def test_a_row_listed_twice_is_one_document(documents):
    line = "a line that two documents hold"
    for rows, dropped in (([(1, line), (1, line), (2, line)], 0), ([(1, line), (1, line + "\nx"), (2, line)], 2)):
        assert lines.drop_repeated_lines(documents(rows)).agg(F.sum("n_dropped")).first()[0] == dropped


def test_perfect_hash():
    r = np.random.default_rng(1)
    h1, h2 = r.integers(0, 2**63, 5000, dtype=np.uint64), r.integers(0, 2**63, 5000, dtype=np.uint64)
    h1[1] = h1[0]  # never told apart by the first hash
    levels, order, left = lines.build_hash(h1, h2)
    at = lines.probe_hash(levels, np.stack([h1[left], h2[left]], 1), h1, h2)
    assert sorted(order) == list(range(5000)) and (order[at] == np.arange(5000)).all()


def test_exact(documents):
    norm = [re.sub("[\x20\x09-\x0d]+", " ", t or "") for _, t in ROWS]
    want = []
    for (i, _), n in zip(ROWS, norm):
        ids = [ROWS[j][0] for j, other in enumerate(norm) if other == n]
        keep = min((x for x in ids if x is not None), default=None)
        want.append((i, keep, len(ids), i == keep, hashlib.sha256(n.encode()).hexdigest()))
    assert sorted(map(str, map(tuple, exact.exact_copies(documents(ROWS)).collect()))) == sorted(map(str, want))
    kept = exact.without_copies(documents(ROWS))
    assert kept.columns == documents(ROWS).columns and kept.count() == len(set(norm))


def test_exact_keeps_columns_of_any_name(documents):
    rows = documents(ROWS)
    for name in ("_norm", "_h1", "_sha", "_keep", "_n", "_id", "_row"):
        rows = rows.withColumn(name, F.lit(name))
    kept = exact.without_copies(rows)
    assert kept.columns == rows.columns
    assert {tuple(r[6:]) for r in kept.collect()} == {("_norm", "_h1", "_sha", "_keep", "_n", "_id", "_row")}
    assert kept.count() == exact.without_copies(documents(ROWS)).count()


def components_of(rows):
    sets = []
    for _, t in rows:
        w = (t or "").encode().lower().split()
        sets.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    comp = list(range(len(rows)))
    for _ in rows:
        for a in range(len(rows)):
            for b in range(len(rows)):
                if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b]):
                    comp[a] = comp[b] = min(comp[a], comp[b])
    return sets, comp


@pytest.mark.parametrize("block", [neardup.BLOCK, 4])
def test_near_duplicates(documents, monkeypatch, block):
    monkeypatch.setattr(neardup, "BLOCK", block)
    r, rows = random.Random(7), list(ROWS)
    for family in range(4):
        base = sentence(150, 100 + family).split()
        for k in range(12):
            copy = list(base)
            for _ in range(k % 6):
                copy[r.randrange(150)] = f"new{r.random()}"
            rows.append((100 + 20 * family + k, " ".join(copy)))
    sets, comp = components_of(rows)
    want = []
    for j, (i, _) in enumerate(rows):
        ids = [x for x in (rows[k][0] for k in range(len(rows)) if comp[k] == comp[j]) if x is not None]
        first = min(ids, default=None) if sets[j] else i
        want.append((i, len(sets[j]), first, i == first))
    # One id, two texts of one component: the ids agree, so both are kept.
    got = neardup.near_duplicates(documents(rows)).select("doc_id", "n_shingles", "component_id", "kept")
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, want))


def test_one_row_of_each_component(documents):
    near = sentence(60, 2) + " end"
    rows = [(1, near), (1, sentence(60, 2)), (1, near), (2, sentence(60, 2)), (None, near), (3, ""), (3, ""), (4, sentence(40, 9)), (4, sentence(40, 9))]
    found = neardup.near_duplicates(documents(rows))
    assert sorted((str(r.doc_id), r.kept) for r in found.collect()) == [
        *[("1", True)] * 3, ("2", False), *[("3", True)] * 2, *[("4", True)] * 2, ("None", False)
    ]
    kept = neardup.without_near_copies(documents(rows))
    assert kept.columns == documents(rows).columns
    assert sorted(r.doc_id for r in kept.collect()) == [1, 3, 3, 4]



def test_pipeline_drops_near_copies_from_80_per_cent(spark, documents):
    import corpus_pipeline

    base = [f"a{k}" for k in range(1000)]
    far = {n: " ".join(f"b{k}" if k % 40 == 20 and k < 40 * n else w for k, w in enumerate(base)) for n in (20, 24)}
    docs = documents([(1, " ".join(base)), (2, far[20]), (3, far[24].replace("a", "c"))])
    stage = dict(corpus_pipeline.STAGES)["near_dedup"]
    assert sorted(r.doc_id for r in stage(spark, docs, SF).collect()) == [1, 3]  # 896 of 1096 shingles are common
    assert neardup.near_duplicates(docs, similarity=85).where("kept").count() == 3
    assert (neardup.matches_for(85), neardup.matches_for(80)) == (40, 35)
    apart = documents([(1, " ".join(base)), (2, far[24])])  # 876 of 1116
    assert stage(spark, apart, SF).count() == 2


@pytest.mark.parametrize("group_runs", [windows.GROUP_RUNS, 1])
def test_windows(documents, group_runs):
    rows = ROWS + [(20, "x" + sentence(60, 2)), (21, "é" * 120), (22, "é" * 90), (None, sentence(50, 2)), (None, None), (8, sentence(90, 12)), (None, "z" + sentence(90, 12))]
    hash_of = {r.text: r.h for r in documents(rows).select("text", F.xxhash64("text").alias("h")).collect()}
    seen, gone_of = {}, {}
    # Null ids first, then by id and text hash; a row listed twice gets one verdict.
    for i, t in sorted(set(rows), key=lambda r: (r[0] is not None, r[0] or 0, hash_of[r[1]])):
        x = (t or "").encode()
        gone = bytearray(len(x))
        for s in range(len(x) - 99):
            if seen.setdefault(x[s : s + 100], (i, t, s)) != (i, t, s):
                gone[s : s + 100] = b"\1" * 100
        gone_of[i, t] = gone
    want = []
    for i, t in rows:
        x, gone = (t or "").encode(), gone_of[i, t]
        spans = sum(1 for k in range(len(x)) if gone[k] and not (k and gone[k - 1]))
        want.append((i, len(x), sum(gone), spans, bytes(b for b, g in zip(x, gone) if not g)))
    got = windows.remove_repeated_windows(documents(rows), group_runs=group_runs).drop("text_hash").collect()
    assert sorted(map(str, ((r[0], r[1], r[2], r[3], bytes(r[4])) for r in got))) == sorted(map(str, want))


def test_windows_of_a_bucket_are_sorted_a_few_digits_at_a_time(monkeypatch):
    texts = [bytes((i * j) % 251 for j in range(130)) for i in (3, 5, 7)]
    table = pa.table(
        {
            "digit": pa.array([i % 3 for i in range(30)], pa.int64()),
            "doc_id": pa.array([None, *range(1, 30)], pa.int64()),
            "text_hash": pa.array(range(30), pa.int64()),
            "start": pa.array([i % 4 for i in range(30)], pa.int32()),
            "bytes": pa.array([texts[i % 3] for i in range(30)], pa.binary()),
        }
    )
    held, at_once = windows._windows_of, []
    monkeypatch.setattr(windows, "_windows_of", lambda part, size: at_once.append(part.num_rows) or held(part, size))
    whole = windows._third_pass(100)(None, table).to_pylist()
    monkeypatch.setattr(windows, "SORTED_BYTES", 1)
    parts = windows._third_pass(100)(None, table).to_pylist()
    assert at_once == [30, 10, 10, 10]
    assert len(whole) == 27 and sorted(map(str, parts)) == sorted(map(str, whole))


def _contexts_of_one_line(n):
    """Contexts around one line of 62 bytes: of equal ones all but the first repeat."""
    r = np.random.default_rng(9)
    sides = r.integers(0, 255, (n // 2, 2, 52), dtype=np.uint8)
    line = bytes(r.integers(0, 255, 62, dtype=np.uint8))
    texts = [sides[i % (n // 2), 0].tobytes() + line + sides[i % (n // 2), 1].tobytes() for i in range(n)]
    columns = {
        "digit": pa.array([5] * n, pa.int64()),
        "doc_id": pa.array([None, *range(1, n)], pa.int64()),
        "text_hash": pa.array(range(n), pa.int64()),
        "start": pa.array([7] * n, pa.int32()),
        "bytes": pa.array(texts, pa.binary()),
    }
    return pa.table(columns)


def test_windows_of_one_digit_need_little_memory():
    import tracemalloc

    n = 8000
    table = _contexts_of_one_line(n)
    tracemalloc.start()
    gone = windows._third_pass(100)(None, table)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert sorted((r["doc_id"], r["start"], r["count"]) for r in gone.to_pylist()) == [(i, 7, 67) for i in range(n // 2, n)]
    assert peak < 80 * n * 67


def test_windows_of_one_digit_are_sorted_by_ranges_of_hashes(monkeypatch):
    table = _contexts_of_one_line(300)
    table = pa.concat_tables([table.take(list(range(299, -1, -1))), table.slice(3, 5)])
    whole = windows._third_pass(100)(None, table).to_pylist()
    monkeypatch.setattr(windows, "SORTED_WINDOWS", 1000)
    parts = windows._third_pass(100)(None, table).to_pylist()
    assert whole == parts and sorted((r["doc_id"], r["start"], r["count"]) for r in whole) == [(i, 7, 67) for i in range(150, 300)]


@pytest.mark.parametrize("shared", [None, 7])
def test_windows_of_rows_that_share_an_id_and_31_bits_of_text(spark, documents, shared):
    """Texts whose hashes agree in their low bits, one long and repeated, one short."""
    low = F.xxhash64("text").bitwiseAND(F.lit((1 << 31) - 1))
    made = spark.range(500_000).select(F.col("id"), F.concat(F.lit("v"), F.col("id").cast("string"), F.repeat(F.lit(" pq rst"), (F.col("id") % 2 * 30).cast("int"))).alias("text"))
    pairs = made.withColumn("low", low).groupBy("low").agg(F.collect_list("text").alias("texts"), F.countDistinct(F.length("text") > 100).alias("n"))
    texts = pairs.where("n = 2").first().texts
    rows = [(shared, texts[0]), (shared, texts[1]), (9, max(texts, key=len))]
    got = {(r.doc_id, r.n_bytes): r.n_removed for r in windows.remove_repeated_windows(documents(rows)).collect()}
    long = len(max(texts, key=len))
    assert got[9, long] == long and got[shared, len(min(texts, key=len))] == 0


@pytest.mark.parametrize("part_bytes", [decontaminate.PART_BYTES, 40])
def test_contamination(spark, documents, part_bytes):
    own = sentence(60, 2).split()
    items = [(1, " ".join(own[5:25])), (2, "ONE, two"), (3, None), (4, ""), (None, "one two"), (2, "one-two"), (5, "never met")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    word = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
    split = lambda t: word.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    want = []
    for i, t in ROWS:
        w, hit, found = split(t), set(), set()
        for item, text in items:
            v = split(text)
            for a in range(max(1, len(v) - 9)) if v else ():
                win = v[a : a + 10]
                for p in range(len(w) - len(win) + 1):
                    if w[p : p + len(win)] == win:
                        hit.update(range(p, p + len(win)))
                        found.add(item)
        want.append((i, len(w), len(hit), sorted(str(x) for x in found if x is not None)))
    rows = decontaminate.contaminated_words(documents(ROWS), bench, part_bytes=part_bytes).collect()
    assert sorted(map(str, ((r.doc_id, r.n_words, r.n_hit, r["items"]) for r in rows))) == sorted(map(str, want))
    text = dict(ROWS[:2])[1]
    spans = next(r.spans for r in rows if r.doc_id == 1)
    assert split(text[spans[0].s : spans[0].e]) == split(" ".join(own[5:25]))
    assert decontaminate.clean(documents(ROWS), bench).count() == sum(1 for x in want if not x[2])


@pytest.mark.parametrize("length,quantum", [(64, 16), (64, 64), (4096, 512)])
def test_packing(documents, length, quantum):
    from collections import Counter

    from tokenizers import Tokenizer

    path = queries.tokenizer_path()
    rows = ROWS + [(30, "İstanbul ΟΔΟΣ ét <|endoftext|>, don't x\x1cy z,%% Ünï. É")]
    pieces = packing.pack(documents(rows), path, 2, length, quantum).collect()
    tokenizer, seen = Tokenizer.from_file(path), {}
    for p in pieces:
        seen.setdefault(p.sequence_id, []).append((p.offset, p.length))
    for spans in seen.values():
        spans.sort()
        assert [o for o, _ in spans] == [sum(n for _, n in spans[:k]) for k in range(len(spans))]
    assert sorted(seen) == list(range(len(seen)))
    assert all(sum(n for _, n in seen[w]) == length for w in range(len(seen) - 1))
    texts = {i: t for i, t in rows}
    for i, t in texts.items():
        ids, met = tokenizer.encode(t or "", add_special_tokens=False).ids + [2], Counter()
        for p in (p for p in pieces if p.doc_id == i):
            part = np.array(ids[p.start : p.start + p.length], "<u4").tobytes()
            assert p.length > 0 and (p.doc_tokens, p.ids_crc32) == (len(ids), zlib.crc32(part))
            met.update(range(p.start, p.start + p.length))
        assert met == Counter({k: sum(j == i for j, _ in rows) for k in range(len(ids))})


def _mixed(spark):
    """Three sources of about 30,000, 20,000 and 10,000 ids, a rare one of one document, and null."""
    rows = [(k, sentence(99, k), source) for k, source in enumerate(["a"] * 60 + ["b"] * 40 + ["c"] * 20)]
    rows += [(900, sentence(150, 900), "rare"), (901, "no source", None), (902, None, "c")]
    return spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, source string, queue string, k int")


def _shares(spark, pieces):
    source_of = {r.doc_id: r.source for r in _mixed(spark).collect()}
    windows = {}
    for p in pieces:
        own = windows.setdefault(p.sequence_id, {})
        own[source_of[p.doc_id]] = own.get(source_of[p.doc_id], 0) + p.length
    return [windows[w] for w in range(len(windows))]


def test_packing_meets_target_shares(spark):
    length, quantum = 1024, 64
    targets = {"a": 0.25, "b": 0.25, "c": 0.5}
    given = spark.createDataFrame([(s, x, "y") for s, x in targets.items()], "source string, share double, note string")
    pieces = packing.pack(_mixed(spark), queries.tokenizer_path(), 2, length, quantum, given).collect()
    windows = _shares(spark, pieces)
    total = sum(w.get("c", 0) for w in windows)
    running = int(total / 0.5 / length)  # until the source with the largest target runs dry
    assert running >= 10
    for w in windows[:running]:
        assert sum(w.values()) == length and set(w) <= set(targets)
        assert all(abs(w.get(s, 0) - share * length) <= 2 * quantum for s, share in targets.items())
    # Deficits carry: over all these windows a source is never a quantum away from its share.
    for upto in range(1, running):
        assert all(abs(sum(w.get(s, 0) for w in windows[:upto]) - share * length * upto) <= 2 * quantum for s, share in targets.items())
    # The other two keep their proportions; what has no target comes last.
    after = [w for w in windows[running + 1 :] if "rare" not in w and None not in w]
    assert len(after) > 5 and all(abs(w.get("a", 0) - w.get("b", 0)) <= 2 * quantum for w in after[:5])
    assert all("rare" not in w and None not in w for w in windows[: len(windows) * 3 // 4])


def test_packing_by_natural_shares(spark):
    length, quantum = 1024, 64
    pieces = packing.pack(_mixed(spark), queries.tokenizer_path(), 2, length, quantum).collect()
    windows = _shares(spark, pieces)
    total = {}
    for w in windows:
        for s, n in w.items():
            total[s] = total.get(s, 0) + n
    for w in windows[:-2]:
        assert all(abs(w.get(s, 0) - length * n / sum(total.values())) <= 2 * quantum for s, n in total.items())
    rare = [p for p in pieces if p.doc_id == 900]
    assert len(rare) <= rare[0].doc_tokens // quantum + 3


def test_secrets_incremental(spark, documents, tmp_path):
    text = 'token: abc token="abcdef12" \U0001f600 api_key=zzzzzzz AKIA' + "B" * 16 + " " + "0f" * 12 + " passwd:x"
    rows = documents([(1, text), (2, text), (3, None), (4, "clean"), (None, text)])
    got = {r.path: r for r in ledger.scan(rows.withColumnRenamed("kept", "blob")).collect()}
    assert got[1].spans == got[2].spans == got[None].spans and got[4].spans == got[3].spans == ""
    start = text.index("token=")
    assert f"assign:{start}:{start + 15}" in got[1].spans and (got[1].n_assign, got[1].n_access, got[1].n_hex) == (2, 1, 1)
    path = str(tmp_path / "ledger")
    ledger.empty_ledger(spark, path)
    versions = rows.select(F.col("doc_id").alias("path"), "text")
    first = ledger.scan_unseen(versions, path, ledger.RULES[:2]).count()
    assert ledger.scan_unseen(versions, path, ledger.RULES[:2]).count() == first == 6
    assert ledger.scan_unseen(versions, path, ledger.RULES[:3]).count() == 9


@pytest.mark.parametrize("ids", [(1, 1), (None, None), (1, 2, 1, 1)])
def test_secrets_of_repeated_rows(documents, ids):
    text = "id " + "0f" * 12 + " or " + "1e" * 12 + " end"
    got = ledger.scan(documents([(i, text) for i in ids])).collect()
    assert [r.path for r in got].count(ids[0]) == ids.count(ids[0]) and len(got) == len(ids)
    assert {(r.n_hex, r.spans) for r in got} == {(2, "hex:3:27,hex:31:55")}
    assert {r.base_sha256 for r in got} == {hashlib.sha256(b"hex:3:27,hex:31:55").hexdigest()}


def test_language(spark):
    found = queries.reg.queries["op4_language_id"](spark, SF).join(table(spark, SF, "documents"), "doc_id")
    right = found.where("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert right > 0.95 and found.where("score < 0 or score > 1").count() == 0


def test_language_edges(documents):
    got = language.identify(documents(ROWS + [(40, "12 34 !")]), ~held_out(3, 1)).collect()
    assert all((r.lang_pred == "und") == (r.doc_id in (3, 4, 12, 40)) for r in got) and len(got) == len(ROWS) + 1
    unlabelled = language.identify(documents(ROWS).withColumn("lang", F.lit(None).cast("string")), F.lit(True))
    assert {(r.lang_pred, r.score) for r in unlabelled.collect()} == {("und", 0.0)}


def test_forward_is_the_sum_over_paths():
    r = np.random.default_rng(3)
    norm = lambda x, axis: x / x.sum(axis, keepdims=True)
    model = hmm.Model(norm(r.random(3), 0), norm(r.random((3, 3)), 1), norm(r.random((5, 3)), 0))
    import itertools

    texts = [np.array(r.integers(0, 5, n), np.uint16) for n in (1, 4, 6)]
    for text, score in zip(texts, hmm.log10_likelihoods(model, texts)):
        total = 0.0
        for path in itertools.product(range(3), repeat=len(text)):
            p = model.start[path[0]] * model.emit[text[0], path[0]]
            for a, b, x in zip(path, path[1:], text[1:]):
                p *= model.move[a, b] * model.emit[x, b]
            total += p
        assert abs(np.log10(total) - score) < 1e-9


@pytest.mark.parametrize("cells", [1, 3, 7, 300_000])
def test_expected_counts_are_the_sums_over_paths(cells):
    import itertools

    r = np.random.default_rng(4)
    norm = lambda x, axis: x / x.sum(axis, keepdims=True)
    model = hmm.Model(norm(r.random(3), 0), norm(r.random((3, 3)), 1), norm(r.random((5, 3)), 0))
    texts = [np.array(r.integers(0, 5, n), np.uint32) for n in (2, 1, 6, 0, 5, 2)]
    emitted, moved, started, likelihood = np.zeros((5, 3)), np.zeros((3, 3)), np.zeros(3), 0.0
    for text in texts:
        paths = {}
        for path in itertools.product(range(3), repeat=len(text)) if len(text) else ():
            p = model.start[path[0]] * model.emit[text[0], path[0]]
            for a, b, x in zip(path, path[1:], text[1:]):
                p *= model.move[a, b] * model.emit[x, b]
            paths[path] = p
        total = sum(paths.values())
        for path, p in paths.items():
            started[path[0]] += p / total
            for state, x in zip(path, text):
                emitted[x, state] += p / total
            for a, b in zip(path, path[1:]):
                moved[a, b] += p / total
        likelihood += np.log(total) if len(text) else 0.0
    got = hmm.expected_counts(model, texts, cells)
    for a, b in zip(got, (emitted, moved, started, likelihood)):
        assert np.allclose(a, b, atol=1e-12)


def test_scores(documents):
    from collections import Counter

    counts, tokens = Counter(), []
    for i, t in ROWS:
        tokens.append((t or "").encode().lower().split() + [None])
        if zlib.crc32(("" if i is None else str(i)).encode()) % 7 != 2:
            counts.update(tokens[-1])
    n, v = sum(counts.values()), len(counts)
    want = sorted((str(i), len(w), sum(counts[x] > 0 for x in w), round(sum(np.log10((counts[x] + 1) / (n + v + 1)) for x in w), 4)) for (i, _), w in zip(ROWS, tokens))
    rows = hmm.score(documents(ROWS), held_out(7, 2)).collect()
    assert sorted((str(r.doc_id), r.n_tokens, r.n_known, round(r.base_score, 4)) for r in rows) == want
    assert all(r.train_tokens == n and r.score < 0 for r in rows)


def test_training_gains(spark):
    docs = table(spark, SF, "documents")
    ready, vocabulary = hmm.prepared(docs, held_out(7, 2))
    _, likelihoods = hmm.train(ready, vocabulary.class_counts(), rounds=4)
    assert likelihoods == sorted(likelihoods)


def test_blocks_grow_before_they_grow_in_number(documents, monkeypatch):
    """A block's words travel every round, so a small table in many partitions is one block."""
    assert [hmm.blocks_of(n << 20, 6) for n in (0, 20, 25, 180, 500, 1000, 1500)] == [1, 1, 2, 8, 12, 12, 18]
    docs = documents([(i, sentence(30, i)) for i in range(60)]).repartition(12)
    ready, _ = hmm.prepared(docs, held_out(7, 2))
    assert ready.rows.where("own is not null").count() == 1
    assert ready.rows.where("own is null").count() == 60
    monkeypatch.setattr(hmm, "BLOCK_BYTES", 4000)
    monkeypatch.setattr(hmm, "HANDED", 1)
    ready, _ = hmm.prepared(docs, held_out(7, 2))
    assert ready.rows.where("own is not null").count() > 3
    assert ready.rows.where("own is null").count() == 60


def test_words_of_twenty_tokens_have_their_own_emissions(documents):
    """Two words of one ending and count, each in its own context, in a text where both are rare."""
    filler = " ".join(f"w{i % 50}" for i in range(200_000))
    learn = [i for i in range(1, 200) if zlib.crc32(str(i).encode()) % 7 != 2]
    test = [i for i in range(1, 200) if i not in learn][:2]
    rows = [(learn[0], filler)] + [(i, ("cold qqing " if i % 2 else "warm zzing ") * 5) for i in learn[1:17]]
    count = {w: sum(t.split().count(w) for _, t in rows) for w in ("qqing", "zzing")}
    less = min(count, key=count.get)
    rows.append((learn[90], " ".join([less] * (max(count.values()) - count[less]))))
    rows += [(test[0], "cold qqing cold qqing"), (test[1], "cold zzing cold zzing")]
    got = {r.doc_id: r for r in hmm.score(documents(rows), held_out(7, 2)).where("held_out").collect()}
    assert abs(got[test[0]].base_score - got[test[1]].base_score) < 1e-9
    assert got[test[0]].score > got[test[1]].score + 0.1


def test_revisit_edges(spark):
    h = {"ETag": '"a"', "Content-Length": "9", "X": "1"}
    rows = [
        (1, "http://WWW.a.com:80/p/?b=1&a=2#f", 1, "response", 200, h),
        (2, "https://a.com/p?a=2&b=1", 2, "revisit", 304, {"etag": 'W/"a"', "content-length": "0", "x": "2"}),
        (3, "https://a.com/p?a=2&b=1", 2, "response", 404, h),
        (4, None, 2, "revisit", 304, None),
        (5, "http://a.com/p?a=2&b=1", None, "revisit", 304, h),
        (6, "http://b.com/", 5, "revisit", 304, h),
        (7, "http://a.com/p?a=2&b=1", 9, "revisit", 304, None),
    ]
    schema = "id long, url string, ts long, kind string, status int, headers map<string,string>"
    got = {r.id: r for r in warc.resolve_revisits(spark.createDataFrame(rows, schema)).collect()}
    assert {k: r.outcome for k, r in got.items()} == {2: "resolved", 4: "no url or time", 5: "no url or time", 6: "no earlier response", 7: "no validator"}
    assert got[2].response_id == 1 and got[2].headers == {"etag": 'W/"a"', "content-length": "9", "x": "2"}


@pytest.mark.parametrize("name", [n for n in sorted(queries.reg.queries) if n != "op8_warc_revisits"] + ["pipeline"])
def test_empty_table(spark, tmp_path, name):
    import __spark_entry__ as entry

    for t in ("documents", "benchmark", "embeddings"):
        table(spark, SF, t).limit(0).write.parquet(f"{tmp_path}/{t}.parquet")
    assert entry.queries()[name](spark, str(tmp_path)).count() == 0


def test_pipeline_stages(spark):
    import corpus_pipeline

    docs = table(spark, SF, "documents")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, docs, SF)
        assert kept.columns == docs.columns and 0 < kept.count() <= docs.count(), name
        docs = spark.createDataFrame(kept.collect(), docs.schema)


def test_the_tokenizer_gets_few_words_at_a_time(monkeypatch):
    path = queries.tokenizer_path()
    texts = pa.array([" ".join(f"{a}{b}{c} {c}{b}'{a}, {a}9{b}-{c}" for a in "abcde" for b in "fghij" for c in "klmno"), None, "it's fine."])
    want = packing.Encoder(path, 2).encode(texts)
    encoder, asked = packing.Encoder(path, 2), []
    simple, whole = encoder._learn_simple, encoder._learn_whole
    monkeypatch.setattr(encoder, "_learn_simple", lambda words: asked.append(len(words)) or simple(words))
    monkeypatch.setattr(encoder, "_learn_whole", lambda words: asked.append(len(words)) or whole(words))
    monkeypatch.setattr(packing, "ASKED", 40)
    assert encoder.encode(texts).equals(want)
    assert max(asked) == 40 and sum(asked) > 300
    ids = packing._tokenizer(path).encode(texts[0].as_py(), add_special_tokens=False).ids
    assert np.frombuffer(want[0].as_py(), encoder.kind).tolist() == [*ids, 2]
