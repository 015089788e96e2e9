import hashlib
import random
import re
import time

import pytest
import xxhash
from pyspark.sql import functions as F

from strandlake.llm import fingerprint as fp

FIELDS = ("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next")


def paragraphs(text):
    return [p for x in text.split("\n") for p in (re.split(fp.SENTENCE_END, x) if len(x) > fp.LONG_LINE else [x])]


def phrases(text):
    out = []
    for p in paragraphs(text):
        if len(p) <= fp.LONG:
            out.append(p)
            continue
        for x in re.split(fp.PHRASE_END, p):
            out += [x] if len(x) <= 2 * fp.LONG else [x[i : i + fp.LONG] for i in range(0, len(x), fp.LONG)]
    return out


def hashed(value, number):
    """Spark's xxhash64 of bytes and an int: the first hash is the second one's seed."""
    return xxhash.xxh64_intdigest(number.to_bytes(4, "little"), seed=xxhash.xxh64_intdigest(value, seed=42))


def vector(text):
    """Lanes of the wide part, lanes of the counting part, and the number of phrases."""
    wide, found = [0] * (fp.WIDE_LANES * fp.WIDE), phrases(text)
    for p in paragraphs(text):
        d = hashlib.sha256(p.encode()).digest()
        for i in range(fp.WIDE):
            x = hashed(d, i + 1)
            for k in range(fp.WIDE_LANES):
                at = fp.WIDE_LANES * i + k
                wide[at] = (wide[at] + (x >> 4 * k)) % 16
    ones = [0] * (4 * fp.LANE_BITS * fp.SIGNS)
    for p in found:
        for s in range(fp.SIGNS):
            x = hashed(p.encode(), s + 1)
            for j in range(fp.LANE_BITS):
                for k in range(4):
                    ones[4 * (fp.LANE_BITS * s + j) + k] += (x >> (j + fp.LANE_BITS * k)) & 1
    return wide, ones, len(found)


def name(text):
    wide, ones, n = vector(text)
    longs = lambda lanes, k, bits: [sum(v << (bits * i) for i, v in enumerate(lanes[at : at + k])) for at in range(0, len(lanes), k)]
    return "".join(f"{x:014x}" for x in longs(wide, fp.WIDE_LANES, 4)) + ":" + "".join(f"{x % 2**60:016x}" for x in [*longs(ones, 4, fp.LANE_BITS), n])


def like(a, b):
    (wa, oa, na), (wb, ob, nb) = vector(a), vector(b)
    if (wa, oa, na) == (wb, ob, nb):
        return 1.0
    sa, sb = [2 * o - na for o in oa], [2 * o - nb for o in ob]
    both = sum(x * y for x, y in zip(sa, sb))
    return max(0.0, min(0.999, 2 * both / (sum(x * x for x in sa) + sum(y * y for y in sb))))


def tie(text):
    h = xxhash.xxh64_intdigest(text.encode(), seed=42)
    return h - 2**64 if h >= 2**63 else h


def brute(rows):
    ordered = sorted(((d, t or "") for d, t in rows), key=lambda r: (r[0] is not None, r[0] or 0, tie(r[1]), r[1]))
    out = []
    for i, (d, t) in enumerate(ordered):
        after = ordered[(i + 1) % len(ordered)][1]
        q = len(t) // 4
        edited = t[: len(t) - q] + after[:q]
        out.append((d, len(t), hashlib.sha256(edited.encode()).hexdigest(), name(t), name(edited), round(like(t, edited), 9), round(like(t, after), 9)))
    return sorted(out, key=repr)


def got(frame):
    assert frame.columns == list(FIELDS)
    return sorted(((*r[:5], round(r[5], 9), round(r[6], 9)) for r in frame.collect()), key=repr)


def test_same_as_brute_force(documents):
    frame, rows = documents
    want = brute([r for r in rows if len(r[1] or "") < 20_000])
    short = frame.where("length(text) < 20000 or text is null")
    for block in (3, 10_000):
        assert got(fp.fingerprint_documents(short, block)) == want


def test_one_and_none(spark, no_documents):
    assert fp.fingerprint_documents(no_documents).count() == 0
    one = spark.createDataFrame([(5, "abcd. efgh")], "doc_id long, text string")
    assert got(fp.fingerprint_documents(one)) == brute([(5, "abcd. efgh")])


def test_many_rows_of_one_id(spark):
    """A null or an id that most rows have is dealt over blocks, and the order holds."""
    rows = [(None if i % 3 else 4, f"text {i}. and more of it {i * 7}") for i in range(60)] + [(i, f"t{i}") for i in range(12)]
    frame = spark.createDataFrame([(*r, 1, 2) for r in rows], "doc_id long, text string, block int, own int").repartition(4)
    dealt, _ = fp.in_blocks(frame.select("doc_id", "text"), 5)
    sizes = [r["count"] for r in dealt.groupBy("block").count().collect()]
    assert len(sizes) > 6 and max(sizes) <= 20
    assert got(fp.fingerprint_documents(frame, 5)) == brute(rows)


def test_order_insert_delete(spark):
    a, b, both = "x y\nz", "p\nq", "q\nx y\np\nz"
    frame = spark.createDataFrame([(a, b, both, a + "\n" + a)], "a string, b string, c string, d string")
    for c in "abcd":
        frame = fp.with_fingerprint(frame, c, c)
    a, b, both, twice = (F.col(c) for c in "abcd")
    row = frame.select(
        fp.combine(a, b) == both, fp.combine(both, b, -1) == a, fp.combine(a, a) == twice, fp.combine(fp.combine(twice, a, -1), a, -1) == fp.combine(a, a, -1), a == both, a == twice,
    ).first()
    assert list(row) == [True] * 4 + [False] * 2


@pytest.mark.parametrize("size, repeated", [(4, 1), (12, 1), (60, 1), (60, 6), (1_000, 1), (1_000, 50)])
def test_likeness_follows_the_shared_part(spark, size, repeated):
    """Of texts of any length, with sentences that repeat too, the likeness rises with the part that is shared."""
    rng = random.Random(size + repeated)
    sentence = lambda: " ".join("".join(rng.choices("abcdefghilmnoprstu", k=rng.randint(3, 9))) for _ in range(rng.randint(3, 9))) + "."
    own = [sentence() for _ in range(size // repeated)] * repeated
    rows = []
    for k in range(5):
        kept = own[: size * k // 4]
        fresh = [sentence() for _ in range(max(1, size // repeated))]
        rows.append((k, " ".join(own), " ".join(kept + [fresh[i % len(fresh)] for i in range(size - len(kept))])))
    frame = spark.createDataFrame(rows, "k int, a string, b string")
    found = fp.with_fingerprint(fp.with_fingerprint(frame, "a", "a"), "b", "b").select("k", fp.likeness(F.col("a"), F.col("b")).alias("x"))
    x = [r["x"] for r in sorted(found.collect())]
    assert x[4] == 1 and x[0] < 0.25 and x == sorted(x)
    assert all(abs(x[k] - k / 4) < 0.25 for k in range(5)), x


def test_long_texts(spark):
    """A megabyte without a blank, and one of short lines."""
    for text in ("x1" * 500_000, "short line\n" * 90_000):
        began = time.perf_counter()
        row = fp.fingerprint_documents(spark.createDataFrame([(1, text), (2, "z " + text[:600_000])], "doc_id long, text string")).collect()
        assert [r["n_chars"] for r in sorted(row)] == [len(text), 600_002] and time.perf_counter() - began < 120
        assert sorted(row)[0]["near_edited"] > 0.5
