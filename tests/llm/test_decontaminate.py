import random

import numpy as np

from strandlake.llm import decontaminate as dc
from tests.llm.conftest import prose


def slow_alignment(a, b):
    best = 0
    h = np.zeros((len(a) + 1, len(b) + 1), int)
    for i, x in enumerate(a, 1):
        for j, y in enumerate(b, 1):
            h[i, j] = max(0, h[i - 1, j - 1] + (1 if x == y else -1), h[i - 1, j] - 1, h[i, j - 1] - 1)
            best = max(best, h[i, j])
    return int(best)


def test_alignment():
    rng = np.random.default_rng(3)
    for _ in range(100):
        a, b = (rng.integers(0, 5, rng.integers(1, 15)) for _ in range(2))
        assert dc.smith_waterman(a, b)[0] == slow_alignment(a.tolist(), b.tolist())


def edited(rng, words, share):
    out = []
    for w in words:
        r = rng.random()
        out += [] if r < share / 3 else ["other%d" % rng.randint(0, 99)] if r < 2 * share / 3 else [w, "more"] if r < share else [w]
    return out


def test_copies_are_found_and_others_left(spark):
    rng = random.Random(9)
    items = [(i, prose(rng, rng.randint(18, 50))) for i in range(20)]
    items += [(90, None), (91, ""), (92, "tiny unusualword phrase"), (5, items[5][1])]
    docs, want = [], set()
    for d in range(160):
        words = prose(rng, rng.randint(20, 300)).split(" ")
        if d % 4 == 0:
            i = rng.randrange(20)
            at = rng.randrange(len(words))
            words[at:at] = edited(rng, items[i][1].upper().split(), 0.0 if d % 8 else 0.2)
            want.add((d, i))
        docs.append((d, " ".join(words)))
    hot = items[7][1]  # stands in very many documents
    docs += [(1000 + k, prose(rng, 30) + "\n" + hot) for k in range(60)]
    want |= {(1000 + k, 7) for k in range(60)}
    docs += [(2000, None), (2001, ""), (2002, "a tiny unusualword phrase here"), (None, "x y z"), (4, docs[4][1])]
    want.add((2002, 92))
    frame = spark.createDataFrame([(d, t, 1.0, "i") for d, t in docs], "doc_id long, text string, score double, item_id string").repartition(3)
    bench = spark.createDataFrame([(i, t, 5) for i, t in items], "item_id long, text string, doc_id int")
    rows = dc.contaminated(frame, bench).collect()
    got = {(r["doc_id"], r["item_id"]) for r in rows}
    assert len(rows) == len(got) and got == want
    assert all(r["score"] == 1.0 for r in rows if r["doc_id"] % 8 and r["doc_id"] < 1000)
    kept = dc.drop_contaminated(frame, bench)
    assert kept.columns == frame.columns
    assert {r["doc_id"] for r in kept.collect()} == {d for d, _ in docs} - {d for d, _ in want}


def test_every_passing_copy_is_found(spark):
    """Copies edited down to the score threshold, between documents that hold the items' common words, against all pairs."""
    rng = random.Random(12)
    items = [(i, prose(rng, rng.randint(12, 45)).lower().replace(".", "").replace(",", "").split()) for i in range(24)]
    docs = [(d, prose(rng, 80).split()) for d in range(60)]
    for i, words in items:
        fourth = [w if k % 4 else "sub%d" % rng.randint(0, 10**6) for k, w in enumerate(words)]
        between = [x for k, w in enumerate(words) for x in ([w, "ins%d" % rng.randint(0, 10**6)] if k % 2 else [w])]
        for k, copy in enumerate((fourth, between, edited(rng, words, 0.25), edited(rng, words, 0.35), words[: len(words) // 2])):
            docs.append((1000 + 10 * i + k, ["w%d" % k for k in range(20)] + copy + ["and", "of", "the"] * 10))
        docs += [(5000 + 10 * i + k, words[at : at + 3] + ["x%d" % k] + words[-3:]) for k, at in enumerate(range(0, len(words) - 8, 2))]  # what little a copy keeps isn't rare
    plain = lambda ws: [w.lower().strip(".,") for w in ws]
    want = {}
    for d, text in docs:
        for i, words in items:
            best = slow_alignment(plain(words), plain(text)) if len(set(plain(words)) & set(plain(text))) >= 5 else 0
            if best >= max(0.4 * len(words), 8):
                want[d, i] = best
    assert len(want) > 90 and any(s == max(-(-2 * len(items[i][1]) // 5), 8) for (_, i), s in want.items())
    frame = spark.createDataFrame([(d, " ".join(t)) for d, t in docs], "doc_id long, text string").repartition(3)
    bench = spark.createDataFrame([(i, " ".join(t)) for i, t in items], "item_id long, text string")
    assert {(r["doc_id"], r["item_id"]): r["matched"] for r in dc.contaminated(frame, bench).collect()} == want


def test_no_rows(spark, no_documents, documents):
    none = spark.createDataFrame([], "item_id long, text string")
    some = spark.createDataFrame([(1, "a b c d")], "item_id long, text string")
    assert dc.contaminated(documents[0], none).count() == 0 and dc.contaminated(no_documents, some).count() == 0
    assert dc.drop_contaminated(documents[0], none).count() == len(documents[1])
