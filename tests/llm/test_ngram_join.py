import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from strandlake.llm import ngram_join as nj
from strandlake.llm.components import components


def brute(rows, n=5, percent=75):
    """component ids by row, from all pairs of sets of words."""
    sets = []
    for _, text in rows:
        words = (text or "").encode().lower().split()
        sets.append({tuple(words[i : i + n]) for i in range(max(1, len(words) - n + 1))} if words else set())
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            shared = len(a & b)
            if a and b and 100 * shared >= percent * (len(a) + len(b) - shared):
                parent[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(least.get(find(i), d), d)
    return [(d, len(sets[i]), least.get(find(i)) if sets[i] else d) for i, (d, _) in enumerate(rows)]


def got(frame):
    return sorted(map(tuple, frame.collect()), key=repr)


def test_same_as_all_pairs(documents):
    frame, rows = documents
    assert got(nj.jaccard_components(frame)) == sorted(brute(rows), key=repr)


@pytest.mark.parametrize("turns", [1, 3])
def test_near_the_threshold(spark, monkeypatch, turns):
    """Groups whose copies are linked to some of the others only, so that blocks are compared too."""
    monkeypatch.setattr(nj, "STAR_TURNS", turns)
    monkeypatch.setattr(nj, "BLOCK", 7)
    rng = random.Random(turns)
    rows = []
    for g in range(3):
        base = ["w%d" % rng.randint(0, 10**6) for _ in range(60)]
        for k in range(40):
            copy = list(base)
            for _ in range(rng.randint(1, 5)):
                copy[rng.randrange(60)] = "v%d" % rng.randint(0, 10**6)
            rows.append((1000 * g + k, " ".join(copy)))
    common = " ".join("c%d" % i for i in range(12))
    rows += [(5000 + i, common + " " + " ".join("x%d" % rng.randint(0, 10**6) for _ in range(rng.randint(0, 30)))) for i in range(40)]
    want = brute(rows)
    assert len({w[2] for w in want}) > 5
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert got(nj.jaccard_components(frame)) == sorted(want, key=repr)


def test_no_rows(no_documents):
    assert got(nj.jaccard_components(no_documents)) == []
    assert nj.drop_near_duplicates(no_documents).count() == 0


def kept_by_rule(rows, n=5):
    """Of each component of rows the least id, null ids last; of rows with equal ids and words in it one. Blank ones all stay."""
    groups, out = {}, []
    for i, (d, t) in enumerate(rows):
        words = (t or "").encode().lower().split()
        if not words:
            out.append((d, t))
    marked = brute([(i, t) for i, (_, t) in enumerate(rows)], n)
    for (i, size, root), (d, t) in zip(marked, rows):
        if size:
            groups.setdefault(root, []).append((d is None, d or 0, t))
    return len(out) + len(groups), {min(g)[1] if not min(g)[0] else None for g in groups.values()} | {d for d, _ in out}


def test_one_of_each_group_stays(documents):
    frame, rows = documents
    kept = nj.drop_near_duplicates(frame)
    assert kept.columns == frame.columns
    n, ids = kept_by_rule(rows)
    found = [r["doc_id"] for r in kept.collect()]
    assert len(found) == n and set(found) == ids


def test_rows_are_judged_by_their_own_text(spark):
    """Equal ids with unlike texts all stay; rows without an id go when linked to one with an id; repeated rows are one."""
    rng = random.Random(8)
    text = lambda: " ".join("w%d" % rng.randint(0, 10**6) for _ in range(60))
    a, b, c, d = text(), text(), text(), text()
    near = lambda t: t.replace(t.split()[30], "edited")
    rows = [(7, a), (7, b), (7, c), (9, near(b)), (None, near(a)), (None, c.upper()), (None, d), (None, near(d)), (7, a), (11, None), (11, None), (None, " "), (3, near(c))]
    frame = spark.createDataFrame([(i, t, 1, 2, "x") for i, t in rows], "doc_id long, text string, _place int, _class long, cls string").repartition(3)
    kept = [(r["doc_id"], r["text"]) for r in nj.drop_near_duplicates(frame).collect()]
    assert sorted([k for k in kept if k[0] is not None or not k[1].strip()], key=repr) == sorted([(7, a), (7, b), (3, near(c)), (11, None), (11, None), (None, " ")], key=repr)
    assert len([k for k in kept if k[0] is None and k[1].strip()]) == 1  # one of d and its copy


def test_heavy_shingles_and_components(spark, monkeypatch):
    """Half of all documents in one group of near copies and one of exact copies, with all frequent shingles heavy."""
    monkeypatch.setattr(nj, "HEAVY_SHINGLES", 200)
    rng = random.Random(5)
    base = ["w%d" % rng.randint(0, 10**6) for _ in range(80)]
    rows = []
    for i in range(120):
        copy = list(base)
        for _ in range(rng.randint(0, 4)):
            copy[rng.randrange(80)] = "v%d" % rng.randint(0, 10**6)
        rows.append((i, " ".join(copy)))
    rows += [(500 + i, "the very same words in every one of them") for i in range(60)] + [(600 + i, None) for i in range(40)]
    rows += [(700 + i, "a passage that is in all of them " * 2 + " ".join("u%d" % rng.randint(0, 10**6) for _ in range(20))) for i in range(60)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert got(nj.jaccard_components(frame)) == sorted(brute(rows), key=repr)
    n, ids = kept_by_rule(rows)
    found = [r["doc_id"] for r in nj.drop_near_duplicates(frame).collect()]
    assert len(found) == n and set(found) == ids


def test_grouped(spark):
    from strandlake.llm import skew

    rows = [(k, i) for k in (1, 2) for i in range(20)] + [(k, 0) for k in range(3, 30)]
    frame = spark.createDataFrame(rows, "k long, v long")
    got = skew.grouped(frame, "k", n=F.count("*"), m=F.max("v"), first=F.min(F.struct("v", "k")))
    assert got.columns == ["k", "v", "n", "m", "first"] and got.count() == len(rows)
    assert {(r["k"], r["n"], r["m"], r["first"]["k"]) for r in got.collect()} == {(k, 20 if k < 3 else 1, 19 if k < 3 else 0, k) for k in range(1, 30)}
    assert skew.grouped(frame, "k", "n > 1", n=F.count("*")).count() == 40


def test_filters_never_lose_a_link():
    rng = np.random.default_rng(0)
    for _ in range(400):
        a = np.unique(rng.integers(0, 120, rng.integers(1, 80)).astype(np.uint64))
        b = a.copy()
        b = np.unique(np.concatenate([np.delete(b, rng.integers(0, len(b), rng.integers(0, 6))), rng.integers(0, 120, rng.integers(0, 6)).astype(np.uint64)]))
        shared = len(np.intersect1d(a, b))
        want = len(a) > 0 and len(b) > 0 and 100 * shared >= 75 * (len(a) + len(b) - shared)
        assert nj.linked(a, b) == want
        assert nj.suffix_bound(a, b) <= len(a) + len(b) - 2 * shared


def test_components(spark):
    chain = [(i + 1, i) for i in range(40)] + [(100, 102), (102, 101), (101, 100), (7, 7)]
    found = {r["node"]: r["label"] for r in components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert found == {i: 0 for i in range(1, 41)} | {101: 100, 102: 100}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
