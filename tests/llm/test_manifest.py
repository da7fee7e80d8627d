"""Merkle manifest, license notices and hard negatives against brute force."""

import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from rawstar.llm import merkle, negatives, notices, queries

LOWER = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# ---- manifest ----

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, tree string, digest string, path string, idx int"


def records(sizes):
    out = [(None, "No Id", None, "b", None), (3, "Twice", "en", "b", 5), (3, "Twice", "en", "b", 5), (3, "Other", "en", "b", 5)]
    out += [(900, None, "en", "b", 0), (901, "", "de", "b", 0), (902, "Ünï Ä B " * 9000, None, "b", 7)]
    number = 1000
    for source, size in sizes.items():
        for _ in range(size):
            out.append((number, f"Text {number} ABC", "en", source, number % 5))
            number += 1
    return out



def leaf(i, text, lang, source, n):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (i, source, lang, n, text)))


def climb(nodes, fanout):
    """(root, proof of each node as [(slot, siblings)])."""
    proofs, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        runs = [nodes[k : k + fanout] for k in range(0, len(nodes), fanout)]
        for leaf_no, place in enumerate(at):
            run, slot = runs[place // fanout], place % fanout
            proofs[leaf_no].append((slot, run[:slot] + run[slot + 1 :]))
        at = [p // fanout for p in at]
        nodes = [sha("".join(run)) for run in runs]
    return nodes[0], proofs


def brute_manifest(rows, fanout):
    groups = {}
    for r in rows:
        groups.setdefault(r[3], []).append(r)
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    parts, roots = {}, []
    for s in order:
        own = sorted(groups[s], key=lambda r: (r[0] is not None, r[0] or 0, leaf(*r)))
        parts[s] = own, *climb([leaf(*r) for r in own], fanout)
        roots.append(parts[s][1])
    root, tops = climb(roots, fanout)
    out = []
    for s, top in zip(order, tops):
        own, subroot, proofs = parts[s]
        for r, proof in zip(own, proofs):
            path = proof + top
            hit = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0
            folded = leaf(r[0], r[1].translate(LOWER) if hit and r[1] else r[1], *r[2:])
            for slot, others in path:
                folded = sha("".join(others[:slot] + [folded] + others[slot:]))
            siblings = "".join("".join(others) for _, others in path)
            out.append((str(r[0]), leaf(*r), subroot, root, sha(siblings), folded, folded == root))
    return sorted(out)


@pytest.mark.parametrize("fanout,sizes", [(16, {"a": 1, "c": 16, "d": 17, "é": 300, None: 40, "": 2}), (2, {"a": 5, None: 8, "z": 1}), (3, {"a": 28}), (16, {})])
def test_manifest(spark, fanout, sizes):
    made = records(sizes)
    rows = spark.createDataFrame([(i, t, lang, s, n, "t", "d", "p", 1) for i, t, lang, s, n in made], SCHEMA)
    found = merkle.proofs(merkle.manifest(rows, merkle.tampered(), fanout))
    path = F.col("path")
    folded = merkle.fold(F.col("claimed"), path)
    got = found.select("doc_id", "digest", "subroot", "root", merkle.proof_digest(path), folded, folded == F.col("root"))
    want = brute_manifest([(i, t, lang, s, n) for i, t, lang, s, n in made], fanout)
    assert sorted((str(r[0]), *r[1:]) for r in got.collect()) == want
    assert not sizes or any(not r[-1] for r in want)


def test_manifest_of_one_row_and_none(spark):
    one = spark.createDataFrame([(7, "x", None, None, None)], "doc_id long, text string, lang string, source string, n_chars long")
    only = merkle.audit(one, F.col("text")).first()
    assert only.leaf == only.subroot == only.root == leaf(7, "x", None, None, None) and only.verified
    assert only.proof_sha256 == sha("") and merkle.audit(one.limit(0), F.col("text")).count() == 0
    made = merkle.manifest(one)
    assert made.subroots().first().asDict() == {"source": None, "subroot": only.leaf} and made.root().first().root == only.leaf


# ---- notices ----

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def least_edits(phrase, words):
    """The fewest errors of ``phrase`` against any run of whole words, by the plain table of edit distances."""
    best = len(phrase)
    for a in range(len(words)):
        for b in range(a + 1, min(len(words), a + len(phrase.split()) + 4) + 1):
            text = " ".join(words[a:b])
            if abs(len(text) - len(phrase)) > 3:
                continue
            row = list(range(len(text) + 1))
            for i, p in enumerate(phrase, 1):
                before, row[0] = row[0], i
                for j, t in enumerate(text, 1):
                    before, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, before + (p != t))
            best = min(best, row[-1])
    return best


def garbled(phrase, errors, r):
    out = list(phrase)
    for _ in range(errors):
        at, kind = r.randrange(len(out)), r.randrange(3)
        if kind == 0:
            out[at] = r.choice("abcxyz ")
        elif kind == 1:
            out.insert(at, r.choice("abc x"))
        elif len(out) > 1:
            del out[at]
    return "".join(out)


def notice_rows():
    r = random.Random(5)
    rows = [(1, None), (2, ""), (None, "MIT License"), (4, "mit-license, (Apache\nLICENSE)! cc_by gnu General public  license"), (4, "MIT License")]
    rows += [(5, "permit licenses emit license"), (6, "mit licensé ÄÖ gnu general public licence."), (7, "cc byte acc by " * 30), (8, "license " * 3000)]
    rows += [(9, "x " * 40_000 + "Apache License" + " y" * 9), (10, "\U0001f600 mit\U0001f600license Mit  License")]
    for k in range(160):
        notice = r.choice(notices.NOTICES)
        fill = [" ".join(r.choice(["the", "mit", "license", "public", "a", "gnu", "cc", "b7"]) for _ in range(6)) for _ in range(2)]
        rows.append((100 + k, f"{fill[0]} {garbled(notice.words, r.randrange(notice.edits + 2), r)} {fill[1]}"))
    return rows


def test_notices(spark):
    rows = notice_rows()
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, labels string, n_words int")
    got = sorted(notices.find_notices(docs).collect(), key=lambda r: (str(r.doc_id), r.n_words, r.labels))
    want = []
    for i, t in rows:
        words = WORD.findall((t or "").translate(LOWER))
        starts, base, labels, score = [], set(), set(), 0.0
        for n in notices.NOTICES:
            size = len(n.words.split())
            exact = [a for a in range(len(words)) if " ".join(words[a : a + size]) == n.words]
            if n.base:
                starts += exact
                base |= {n.label} if exact else set()
            short = words if len(words) < 500 else [w for k, w in enumerate(words) if words[k - 1] != w or words[k - 2] != w]
            errors = 0 if exact else least_edits(n.words, short)
            if errors <= n.edits:
                labels.add(n.label if not errors else n.near_label)
                score = max(score, 1 - errors / len(n.words))
        want.append((str(i), len(words), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(base)), labels, score))
    want.sort(key=lambda r: (r[0], r[1], sorted(r[6])))
    assert len(got) == len(want)
    for g, w in zip(got, want):
        assert (str(g.doc_id), g.n_words, g.n_base, g.first_word, g.last_word, g.base_labels) == w[:6]
        # Beside an exact place, a place with errors may stand too.
        assert w[6] <= set(filter(None, g.labels.split(","))) <= w[6] | {x + "~" for x in w[6]}, (g, w)
        assert g.score == pytest.approx(w[7])


def test_notice_spans(spark):
    text = "ÄX \U0001f600, Apache\t- Licence; MIT License."
    found = notices.find_notices(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert [(m.label, m.edits, text[m.s : m.e]) for m in found.matches] == [("apache~", 1, "Apache\t- Licence"), ("mit", 0, "MIT License")]
    assert (found.n_base, found.first_word, found.base_labels, found.labels, found.score) == (1, 4, "mit", "apache~,mit", 1.0)


# ---- hard negatives ----


def brute_negatives(rows, label_of, low=80, high=100, k=5, keep=5):
    import math

    ready = []
    for i, v, label in rows:
        if label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        ready.append((i, [math.floor(256 * x) for x in v], label_of(i, label)))
    order = lambda x: (-x[0], x[1] is None, x[1] or 0)
    out = []
    anchors = {(i, tuple(v), label) for i, v, label in ready if i is not None and i % 100 == 0}
    for i, v, label in anchors:
        score = lambda w: sum(a * b for a, b in zip(v, w))
        positives = sorted(((score(w), j) for j, w, m in ready if m == label and j != i), key=order)[:k]
        others = sorted(((score(w), j) for j, w, m in ready if m != label), key=order)
        for p, j in positives:
            band = [x for x in others if low * p <= 100 * x[0] <= high * p][:keep]
            out += [(i, j, n, q, p, s) for n, (s, q) in enumerate(band, 1)]
    return sorted(map(str, out))


def moved(i, label):
    return label if i is None or i % 7 else (label + 1) % 10


@pytest.mark.parametrize("block,low,high", [(negatives.BLOCK, 80, 100), (16, 80, 100), (64, 50, 120)])
def test_negatives(spark, monkeypatch, block, low, high):
    monkeypatch.setattr(negatives, "BLOCK", block)
    monkeypatch.setattr(negatives, "SLICE", 200)
    r = random.Random(3)
    rows = [(i, [r.choice([-0.5, 0.25, 0.5, 0.75, 1.0]) for _ in range(3)], r.randrange(3)) for i in range(301)]
    common = [0.5, 0.5, 0.5]
    rows += [(i, common, i % 3) for i in range(400, 520)] + [(500, common, 1), (500, common, 1), (500, [0.25, 0.5, 0.75], 2)]
    rows += [(None, common, 0), (None, common, 1), (600, None, 1), (601, [None, 0.5], 1), (602, [float("nan"), 1.0], 1)]
    rows += [(603, [float("inf")], 0), (700, [], 1), (800, [1.0, 0.5], 1), (900, [0.5, 1.0, 0.5, 9.0], 2), (1000, [-1.0, -1.0, -1.0], 5), (1001, [1.0], None)]
    table = spark.createDataFrame([(i, v, m, 1, "x") for i, v, m in rows], "vec_id long, embedding array<float>, label int, id int, slot string")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    got = negatives.hard_negatives(table, F.col("vec_id") % 100 == 0, label, low=low, high=high)
    assert sorted(map(str, map(tuple, got.collect()))) == brute_negatives(rows, moved, low, high)


def test_negatives_of_large_components(spark):
    big = float(2**40)
    rows = [(0, [big, 1.0], 1), (1, [big, 2.0], 1), (2, [big, 1.5], 2), (3, [big, 2.5], 2)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    with pytest.raises(Exception, match="64 bits"):
        negatives.hard_negatives(table, F.col("vec_id") % 100 == 0, F.col("label")).count()
    small = [(i, [x / 2**20 for x in v], m) for i, v, m in rows]
    table = spark.createDataFrame(small, "vec_id long, embedding array<double>, label int")
    got = negatives.hard_negatives(table, F.col("vec_id") % 100 == 0, F.col("label"))
    assert sorted(map(str, map(tuple, got.collect()))) == brute_negatives(small, lambda i, m: m)


def test_no_vectors(spark, tmp_path):
    spark.createDataFrame([], "vec_id long, embedding array<float>, label int").write.parquet(f"{tmp_path}/embeddings.parquet")
    assert queries.reg.queries["op13_hard_negatives"](spark, str(tmp_path)).count() == 0
