"""N-gram Jaccard join: near duplicates by shared word shingles, exactly, and their components.

1. Sets. A document's set of 64-bit shingle hashes gets a 64-bit key; documents with equal
   sets are one class. The shingles' frequencies are counted: those of the heavy ones, of
   which there is a fixed number at most, one by one, and those of the others in a table of
   fixed size, by the top bits of the hash. (Hash, then: two of n classes are taken for one
   with a chance of about n*n/2^65.)
2. First prefixes. A class's shingles are ordered by that count, in powers of two, and the
   hash. Sets with a Jaccard similarity of t share one of the first n - ceil(t n) + 1 of each,
   and k of the first n - ceil(t n) + k; with k about n/5 these are shuffled by shingle, once
   per class and task. There a shingle's exact frequency among the prefixes is known.
3. Second prefixes. Within its first prefix, a class's shingles are ordered rare first by that
   frequency. As k are shared, one of all but the last k - 1 is; those that are in no other
   prefix can't be it. Little is left of a class without a near duplicate.
4. Stars. Under a shingle, one class of the largest component is paired with each class of
   other components. Pairs that pass the length and positional filter are verified once, with
   the suffix filter before the exact count; the links found give new components. This is
   repeated a few times with other classes in the middle.
5. The rest. Only classes of different components that share a shingle of their second
   prefixes can still be linked. They are dealt into blocks, by component or, if alone, by
   their commonest shingle; blocks that meet are compared as wholes, each class of one with
   all sets of the other at once. A group of copies is one component by then, and what is
   near it but not linked to it is compared with it in blocks, not in pairs of rows; no link
   between components is lost.

A shingle, class or component may hold a third of all rows. Rows of heavy shingles are dealt
over several tasks; statistics by key are aggregated and joined back, with one row per key on
one side, so that the other can be split. Nothing proportional to the corpus reaches the driver: it gets the counts, a bitmap and
heavy keys, all of fixed size at most.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strandlake.llm.common import WordHash, drop_scratch, free_name, materialize, ngram_hashes, read_table, tidy, white_words
from strandlake.llm.components import components
from strandlake.llm.skew import grouped
from strandlake.operators.dataflow import small
from strandlake.session import shipped

SHINGLE, PERCENT = 5, 75
COUNT_BITS = 18
#: Shingles that a task counts one by one at most; one with more than twice this part of all is found for sure.
COUNTED = 4096
#: A shingle is heavy if it is more than this part of all. Its rows are dealt over a task for each such part, up to MOST_PARTS.
HEAVY_SHINGLES = 20_000
MOST_PARTS = 1024
#: What is known of a class under a shingle.
FIELDS = ("cls", "n", "size", "u", "pos")
BITMAP_BITS = 23
#: Turns of star pairs at most, before all that is left is compared.
STAR_TURNS = 2
#: Classes of a block in the comparison of what is left.
BLOCK = 200


def shingle_set(text: str | None, known: WordHash, n: int = SHINGLE) -> np.ndarray:
    """Sorted distinct shingle hashes of the whole text; the whole sequence as one if it is shorter; empty if no word."""
    return np.unique(ngram_hashes(known.of(white_words(text)), n))


def class_key(shingles: np.ndarray) -> int:
    """Signed 64-bit key of a set."""
    return int(np.int64(np.uint64(xxhash.xxh3_64_intdigest(shingles.tobytes()))))


def least_shared(na: int, nb: int, percent: int = PERCENT) -> int:
    """Shared shingles that sets of these sizes need: the least k with 100 k >= percent * (na + nb - k)."""
    return -(-percent * (na + nb) // (100 + percent))


def slack(n):
    """How many shingles more than one a prefix shares for sure: a fifth of the size. For numbers and Columns."""
    return n // 5 + 1 if isinstance(n, int) else F.floor(n / 5) + 1


def prefix_length(n: int, percent: int = PERCENT) -> int:
    """Length of the first prefix: two linked sets share ``slack`` of the smaller of them in theirs."""
    return n - -(-percent * n // 100) + slack(n)


def suffix_bound(a: np.ndarray, b: np.ndarray, depth: int = 3) -> int:
    """At least so many values are in one of two sorted sets only: halves around a pivot differ in size by as many."""
    if not depth or not len(a) or not len(b):
        return abs(len(a) - len(b))
    pivot = b[len(b) // 2]
    i, j = np.searchsorted(a, pivot), len(b) // 2
    return suffix_bound(a[:i], b[:j], depth - 1) + suffix_bound(a[i:], b[j:], depth - 1)


def linked(a: np.ndarray, b: np.ndarray, percent: int = PERCENT) -> bool:
    """Whether two sorted sets are similar enough; the suffix filter comes before the count."""
    need = least_shared(len(a), len(b), percent)
    if not len(a) or not len(b) or min(len(a), len(b)) < need:
        return False
    if suffix_bound(a, b) > len(a) + len(b) - 2 * need:
        return False
    small, large = (a, b) if len(a) <= len(b) else (b, a)
    at = np.searchsorted(large, small)
    at[at == len(large)] = 0
    return int((large[at] == small).sum()) >= need


class _Counts:
    """Counts of shingles: by bucket, exactly; and one by one for the frequent ones, too low by the same part of all at most.

    Of more than ``COUNTED`` shingles those with the highest counts stay, less the highest
    count that goes (Misra and Gries).
    """

    def __init__(self):
        self.buckets = np.zeros(1 << COUNT_BITS, np.int64)
        self.shingles, self.hits = np.zeros(0, np.uint64), np.zeros(0, np.int64)

    def add(self, sets: list[np.ndarray]) -> None:
        values, n = np.unique(np.concatenate(sets), return_counts=True)
        self.buckets += np.bincount((values >> np.uint64(64 - COUNT_BITS)).astype(np.int64), weights=n, minlength=1 << COUNT_BITS).astype(np.int64)
        often = n > 1
        both = np.concatenate([self.shingles, values[often]])
        self.shingles, where = np.unique(both, return_inverse=True)
        self.hits = np.bincount(where, weights=np.concatenate([self.hits, n[often]]), minlength=len(self.shingles)).astype(np.int64)
        if len(self.hits) > COUNTED:
            self.hits = self.hits - np.partition(self.hits, -COUNTED - 1)[-COUNTED - 1]
            stay = self.hits > 0
            self.shingles, self.hits = self.shingles[stay], self.hits[stay]


def _sets(docs: DataFrame, n: int) -> DataFrame:
    """Per document its set's size and class; and per task the counts of the shingles' buckets and of frequent shingles."""
    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, counts = WordHash(), _Counts()
        names = ["doc_id", "n_shingles", "cls", "bucket", "shingle", "hits"]

        def no(k, kind=None):
            return pa.nulls(k, kind or pa.int64())

        for batch in batches:
            size, key, held, n_held = [], [], [], 0
            for text in batch.column(1):
                s = shingle_set(text.as_py(), known, n)
                size.append(len(s))
                key.append(class_key(s) if len(s) else None)
                held.append(s)
                n_held += len(s)
                if n_held > 250_000:
                    counts.add(held)
                    held, n_held = [], 0
            if held:
                counts.add(held)
            k = len(size)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(size, pa.int64()), pa.array(key, pa.int64()), no(k, pa.int32()), no(k), no(k)], names=names)
        used = np.flatnonzero(counts.buckets)
        for at in range(0, len(used), 50_000):
            u = used[at : at + 50_000]
            k = len(u)
            yield pa.RecordBatch.from_arrays([no(k), no(k), no(k), pa.array(u.astype(np.int32)), no(k), pa.array(counts.buckets[u])], names=names)
        k = len(counts.hits)
        yield pa.RecordBatch.from_arrays([no(k), no(k), no(k), no(k, pa.int32()), pa.array(counts.shingles.view(np.int64)), pa.array(counts.hits)], names=names)

    return shipped(docs).mapInArrow(run, "doc_id long, n_shingles long, cls long, bucket int, shingle long, hits long")


@dataclass
class _Order:
    """What is known of the shingles' frequencies: a level by bucket, and the heavy shingles (ascending) with their counts."""

    level: np.ndarray
    heavy: np.ndarray
    hits: np.ndarray
    parts: np.ndarray

    def places(self, s: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each shingle its place among the heavy ones, and whether it is one."""
        if not len(self.heavy):
            return np.zeros(len(s), np.int64), np.zeros(len(s), bool)
        at = np.minimum(np.searchsorted(self.heavy, s), len(self.heavy) - 1)
        return at, self.heavy[at] == s


def _order(counted: DataFrame) -> _Order:
    """From the rows of ``_sets`` that count: 2^18 buckets, and ``HEAVY_SHINGLES`` shingles at most."""
    table = counted.where("bucket is not null").groupBy("bucket").agg(F.sum("hits").alias("hits")).toArrow()
    counts = np.zeros(1 << COUNT_BITS, np.int64)
    counts[table.column("bucket").to_numpy()] = table.column("hits").to_numpy()
    most = max(1, int(counts.sum()) // HEAVY_SHINGLES)
    table = counted.where("shingle is not null").groupBy("shingle").agg(F.sum("hits").alias("hits")).where(F.col("hits") > most).toArrow()
    heavy, hits = table.column("shingle").to_numpy().view(np.uint64), table.column("hits").to_numpy()
    by_hash = np.argsort(heavy)
    heavy, hits = heavy[by_hash], hits[by_hash]
    np.subtract.at(counts, (heavy >> np.uint64(64 - COUNT_BITS)).astype(np.int64), hits)
    level = np.zeros(len(counts), np.uint8)
    usual = counts.mean() + 6 * np.sqrt(counts.mean()) + 1
    level[counts > usual] = np.log2(counts[counts > usual] / usual).astype(np.uint8) + 1
    return _Order(level, heavy, hits, np.minimum(-(-hits // most), MOST_PARTS))


def _prefixes(docs: DataFrame, order: _Order, n: int, percent: int) -> DataFrame:
    """The first prefix of each class, once per task: light shingles by their bucket's level, heavy ones by count, then by hash.

    ``part`` deals the rows of a heavy shingle, by class; it is -1 for the others.
    """
    shared = docs.sparkSession.sparkContext.broadcast(order)  # 2^18 bytes and 24 for each heavy shingle

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, seen, order = WordHash(), set(), shared.value
        heavy_level = 64 + np.log2(np.maximum(order.hits, 1)).astype(np.int64)
        for batch in batches:
            parts, keys, sizes = [], [], []

            def flush():
                key = np.repeat(np.array(keys, np.int64), [len(p) for p in parts])
                size = np.repeat(np.array(sizes, np.int32), [len(p) for p in parts])
                h = np.concatenate(parts)
                at, heavy = order.places(h)
                part = np.full(len(h), -1, np.int32)
                part[heavy] = (key[heavy] >> 20) % order.parts[at[heavy]]
                return pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(part), pa.array(key), pa.array(size)], names=["h", "part", "cls", "n"])

            held = 0
            for text in batch.column(0):
                s = shingle_set(text.as_py(), known, n)
                if not len(s):
                    continue
                key = class_key(s)
                if key in seen:
                    continue
                seen.add(key)
                p = prefix_length(len(s), percent)
                level = order.level[(s >> np.uint64(64 - COUNT_BITS)).astype(np.int64)].astype(np.int64)
                at, heavy = order.places(s)
                level[heavy] = heavy_level[at[heavy]]
                parts.append(s[np.argsort(level, kind="stable")[:p]])
                keys.append(key)
                sizes.append(len(s))
                held += p
                if held > 200_000:
                    yield flush()
                    parts, keys, sizes, held = [], [], [], 0
            if parts:
                yield flush()

    return shipped(docs).select("text").mapInArrow(run, "h long, part int, cls long, n int")


def _shared(prefixes: DataFrame, order: _Order) -> DataFrame:
    """Rows of shingles in the prefixes of two classes or more, with how many (beyond 2^20: 2^20).

    Rows of one shingle stream through in order; up to 2^20 of them are held back until their
    number is known. Those of a heavy shingle come in several tasks; all pass, with a number
    above the others' made from its count, the same in all of them.
    """
    most = 1 << 20
    shared = prefixes.sparkSession.sparkContext.broadcast(order)

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["h", "cls", "n", "df"]

        def out(h, cls, n, df):
            return pa.RecordBatch.from_arrays([pa.array(h), pa.array(cls), pa.array(n), pa.array(df)], names=names)

        now, parts, held, heavy, last = None, [], 0, False, None  # ``now``: the shingle that the last batch ended with

        def settle(df):
            cls, n = (np.concatenate(x) for x in zip(*parts))
            return out(np.full(len(cls), now, np.int64), cls, n, np.full(len(cls), df, np.int32))

        for batch in batches:
            h, part, cls, n = (batch.column(i).to_numpy() for i in range(4))
            keep = np.ones(len(h), bool)
            keep[1:] = (h[1:] != h[:-1]) | (cls[1:] != cls[:-1])
            if len(h):
                keep[0] = last is None or last != (h[0], cls[0])
                last = (h[-1], cls[-1])
            h, part, cls, n = h[keep], part[keep], cls[keep], n[keep]
            dealt = part >= 0
            if dealt.any():
                hits = shared.value.hits[shared.value.places(h[dealt].view(np.uint64))[0]]
                yield out(h[dealt], cls[dealt], n[dealt], np.minimum(most + hits, 1 << 30).astype(np.int32))
                h, cls, n = h[~dealt], cls[~dealt], n[~dealt]
            if not len(h):
                continue
            if now is not None:
                more = int(np.searchsorted(h, now, "right")) if h[0] == now else 0
                if more:
                    parts.append((cls[:more], n[:more]))
                    held += more
                    if heavy or held > most:
                        yield settle(most)
                        parts, heavy = [], True
                h, cls, n = h[more:], cls[more:], n[more:]
                if not len(h):
                    continue
                if not heavy and held > 1:
                    yield settle(held)
            starts = np.flatnonzero(np.append(True, h[1:] != h[:-1]))
            sizes = np.diff(np.append(starts, len(h)))
            df, tail = np.repeat(sizes, sizes), starts[-1]
            pick = np.flatnonzero(df[:tail] > 1)
            if len(pick):
                yield out(h[pick], cls[pick], n[pick], df[pick].astype(np.int32))
            now, parts, held, heavy = h[-1], [(cls[tail:], n[tail:])], len(h) - tail, False
        if now is not None and not heavy and held > 1:
            yield settle(held)

    ordered = prefixes.repartition("h", "part").sortWithinPartitions("h", "cls")
    return shipped(ordered).mapInArrow(run, "h long, cls long, n int, df int")


def _least_need(a_low, b_low, a_high, b_high, percent: int):
    """At least so many shingles of their first prefixes are shared by linked sets a and b with sizes in these ranges."""
    up, down = percent / (100 + percent), percent / 100 - 0.2 - percent / (100 + percent)
    return F.least(b_low * up - a_high * down, a_low * up - b_high * down) - 3


def _second_prefixes(shared: DataFrame, percent: int) -> DataFrame:
    """Of each class's first prefix, what is left of its second one when shingles that nothing else has come first.

    ``u`` of the ``size`` shingles of the first prefix are in no other one; ``pos`` is a
    shingle's place when they come first and the others follow, the rarest ahead. Shingles of
    one class go, and rows whose class has too little in common with all others for any
    class of a size found under the shingle. ``lead`` is the smallest class under it.
    """
    w = Window.partitionBy("cls")
    n = F.col("n")
    least_other = F.ceil(n * percent / 100)
    size = n - least_other + slack(n)
    placed = shared.select(
        "h", "cls", "n", size.cast("int").alias("size"), (size - F.count("*").over(w)).cast("int").alias("u"),
        F.row_number().over(w.orderBy("df", "h")).alias("_r"),
    )
    length = F.col("size") - slack(least_other) + 1
    kept = placed.where(F.col("_r") <= length - F.col("u")).select("h", "cls", "n", "size", "u", (F.col("u") + F.col("_r") - 1).cast("int").alias("pos"))
    kept = materialize(kept, "second-prefixes")
    rows = grouped(kept, "h", "_m > 1", _lead=F.min(F.struct("n", "cls", "size", "u", "pos")), _m=F.count("*"), _n0=F.min("n"), _n1=F.max("n"))
    low, high = F.greatest("_n0", n * percent / 100), F.least("_n1", n * 100 / percent)
    lead = F.struct(*(F.col(f"_lead.{f}").alias(f) for f in FIELDS)).alias("lead")
    found = rows.where(F.col("size") - F.col("u") >= _least_need(n, low, n, high, percent)).select("h", *FIELDS, lead)
    found = materialize(found, "members")
    drop_scratch(kept)
    return found


def _may_link_pairs(rows: DataFrame, percent: int) -> DataFrame:
    """Distinct pairs (``a``, ``b``) of the structs ``a`` and ``b`` that may be linked."""
    sides = rows.select(*(F.col(f"{x}.{f}").alias(f"{x}_{f}") for x in "ab" for f in FIELDS))
    return sides.where(_may_link(percent)).select(F.least("a_cls", "b_cls").alias("a"), F.greatest("a_cls", "b_cls").alias("b")).distinct()


def _star_pairs(members: DataFrame, turn: int, percent: int) -> DataFrame:
    """Under each shingle, one class of the largest component with every class of other components, if they may link.

    The one is chosen by a hash that is another in each turn and the same under all shingles,
    so few classes are chosen in a group of copies.
    """
    first = F.min(F.struct((-F.col("comp_size")).alias("_size"), F.xxhash64(F.lit(turn), "cls").alias("_by"), *FIELDS, "comp"))
    rows = grouped(members, "h", a=first).select("a", F.struct(*FIELDS, "comp").alias("b"))
    return _may_link_pairs(rows.where("a.comp <> b.comp"), percent)


def _blocks(members: DataFrame) -> DataFrame:
    """``cls, comp, block``: about BLOCK classes of one component in a block; those alone by their commonest shingle."""
    counted = grouped(members, "h", _c=F.count("*"))
    each = counted.groupBy("cls").agg(F.first("comp").alias("comp"), F.first("comp_size").alias("comp_size"), F.max(F.struct("_c", "h"))["h"].alias("_h"))
    each = each.withColumn("_alone", F.col("comp_size") == 1).withColumn("_cluster", F.when(F.col("_alone"), F.col("_h")).otherwise(F.col("comp")))
    part = F.pmod(F.xxhash64("cls"), F.ceil(F.col("_n") / BLOCK))
    each = each.select("cls", "comp", F.xxhash64("_alone", "_cluster").alias("_in"))
    sizes = each.groupBy("_in").agg(F.count("*").alias("_n"))
    return each.join(sizes, "_in").select("cls", "comp", F.xxhash64("_in", part).alias("block"))


def _block_pairs(members: DataFrame, blocks: DataFrame, percent: int) -> DataFrame:
    """Pairs of blocks (``a``, ``b``) that meet under a shingle with classes that may link, by the blocks' extremes there."""
    met = members.select("h", *FIELDS).join(blocks, "cls").groupBy("h", "block").agg(
        F.min("n").alias("n0"), F.max("n").alias("n1"), F.max(F.col("pos") - F.col("u")).alias("before"),
        F.max(F.col("size") - F.col("pos") - 1).alias("behind"), F.min("comp").alias("lo"), F.max("comp").alias("hi"),
    )
    names = ["block", "n0", "n1", "before", "behind", "lo", "hi"]
    a, b = (met.select("h", *(F.col(c).alias(f"{x}_{c}") for c in names)) for x in "ab")
    c = F.col
    sizes_fit = (c("a_n1") * 100 >= c("b_n0") * percent) & (c("b_n1") * 100 >= c("a_n0") * percent)
    need = _least_need(c("a_n0"), c("b_n0"), c("a_n1"), c("b_n1"), percent)
    most = F.least("a_before", "b_before") + 1 + F.least("a_behind", "b_behind")
    one_component = (c("a_lo") == c("a_hi")) & (c("a_lo") == c("b_lo")) & (c("b_lo") == c("b_hi"))
    fits = (c("a_block") <= c("b_block")) & ~one_component & sizes_fit & (most >= need)
    return a.join(b, "h").where(fits).select(c("a_block").alias("a"), c("b_block").alias("b")).distinct()


def _block_links(pairs: DataFrame, blocks: DataFrame, texts: DataFrame, n: int, percent: int) -> DataFrame:
    """Links between the classes of paired blocks, for each class of one at most one to each component in the other.

    A pair of blocks is one task's work: the sets of one are put into one sorted array, and
    a class of the other is counted against all of them at once.
    """
    named = pairs.withColumn("pair", F.xxhash64("a", "b"))
    rows = small(blocks).join(texts, "cls").select("block", "cls", "comp", "text")
    side = lambda x, probe: small(named.select("pair", F.col(x).alias("block"), F.lit(probe).alias("probe"))).join(rows, "block").select("pair", "cls", "comp", "text", "probe")
    ordered = side("b", False).unionByName(side("a", True)).repartition("pair").sortWithinPartitions("pair", "probe")

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHash()
        now, cls, comps, sets, index = None, [], [], [], None
        for batch in batches:
            out = []
            for pair, key, comp, text, probe in zip(*(batch.column(i).to_pylist() for i in (0, 1, 2)), batch.column(3), batch.column(4).to_pylist()):
                if pair != now:
                    now, cls, comps, sets, index = pair, [], [], [], None
                own = shingle_set(text.as_py(), known, n)
                if not probe:
                    cls.append(key)
                    comps.append(comp)
                    sets.append(own)
                    continue
                if index is None:
                    tokens, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), [len(x) for x in sets])
                    order = np.argsort(tokens, kind="stable")
                    index = tokens[order], owner[order], np.array([len(x) for x in sets]), np.array(comps, np.int64), np.array(cls, np.int64)
                tokens, owner, sizes, of, keys = index
                lo, hi = np.searchsorted(tokens, own, "left"), np.searchsorted(tokens, own, "right")
                count = hi - lo
                at = np.repeat(lo - np.append(0, np.cumsum(count)[:-1]), count) + np.arange(count.sum())
                shared = np.bincount(owner[at], minlength=len(sizes))
                fits = (100 * shared >= percent * (len(own) + sizes - shared)) & (of != comp)
                for one in np.unique(of[fits]):
                    out.append((key, int(keys[fits][of[fits] == one][0])))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*out)], names=["a", "b"])

    return shipped(ordered).select("pair", "cls", "comp", "text", "probe").mapInArrow(run, "a long, b long")


def _with_components(members: DataFrame, labels: DataFrame) -> DataFrame:
    """Members with their component and its size, under shingles of more than one component only."""
    sizes = labels.groupBy("label").agg((F.count("*") + 1).alias("_n"))
    sized = labels.join(sizes, "label").select(F.col("node").alias("cls"), "label", "_n").union(sizes.select(F.col("label").alias("cls"), "label", "_n"))
    sized = small(materialize(sized, "sized"))
    named = members.select("h", *FIELDS).join(sized, "cls", "left").select(
        "h", *FIELDS, F.coalesce("label", "cls").alias("comp"), F.coalesce("_n", F.lit(1).cast("bigint")).alias("comp_size")
    )
    named = materialize(named, "named")
    return grouped(named, "h", "_lo <> _hi", _lo=F.min("comp"), _hi=F.max("comp")).drop("_lo", "_hi")


def _may_link(percent: int) -> Column:
    """Length filter, and positional filter on the first prefixes, of rows with the sides ``a`` and ``b``.

    Linked sets share at least ``need`` shingles of their first prefixes. None of those that
    come first in either and are in no other prefix is shared; of the others at most the
    shorter part before and behind.
    """
    c = F.col
    longest, shortest = F.greatest("a_n", "b_n"), F.least("a_n", "b_n")
    overlap = F.ceil((c("a_n") + c("b_n")) * percent / (100 + percent))
    sure = lambda n: overlap - F.ceil(n * percent / 100) + slack(n)
    need = F.least(sure(c("a_n")), sure(c("b_n")))
    before = F.least(c("a_pos") - c("a_u"), c("b_pos") - c("b_u"))
    behind = F.least(c("a_size") - c("a_pos"), c("b_size") - c("b_pos")) - 1
    return (shortest * 100 >= longest * percent) & (before + 1 + behind >= need)


def _bitmap(ids: DataFrame) -> np.ndarray:
    """A bitmap of fixed size of hashed ``doc_id``s."""
    bit = F.pmod(F.xxhash64("doc_id"), F.lit(1 << BITMAP_BITS))
    words = (
        ids.select(F.shiftright(bit, 6).cast("int").alias("word"), F.expr(f"shiftleft(1L, cast(pmod(xxhash64(doc_id), {1 << BITMAP_BITS}) & 63 as int))").alias("bits"))
        .groupBy("word").agg(F.bit_or("bits").alias("bits"))
    )
    table = words.toArrow()  # 2^17 rows at most
    out = np.zeros(1 << (BITMAP_BITS - 6), np.int64)
    out[table.column("word").to_numpy()] = table.column("bits").to_numpy()
    return out


def _hits(bits: np.ndarray, place: pa.Array) -> np.ndarray:
    bit = place.to_numpy()
    return (bits[bit >> 6] >> (bit & 63)) & 1 == 1


def _placed(docs: DataFrame) -> DataFrame:
    """``docs`` with the place of their id in a bitmap as the last column."""
    name = free_name(docs.columns, "_place")
    return shipped(docs).select("*", F.pmod(F.xxhash64(F.col("doc_id").cast("long")), F.lit(1 << BITMAP_BITS)).alias(name))


def _by_bitmap(docs: DataFrame, bits: np.ndarray, hit: bool, key_name: str | None = None, n: int = SHINGLE) -> DataFrame:
    """Rows of ``docs`` whose ``doc_id`` is in a bitmap, or those whose isn't; with their class in a column of that name."""
    shared = docs.sparkSession.sparkContext.broadcast(bits)
    at = docs.columns.index("text")

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHash()
        for batch in batches:
            keep = _hits(shared.value, batch.column(batch.num_columns - 1)) == hit
            if not keep.any():
                continue
            kept = batch.select(range(batch.num_columns - 1)).filter(pa.array(keep))
            if key_name:
                sets = (shingle_set(t.as_py(), known, n) for t in kept.column(at))
                kept = kept.append_column(key_name, pa.array([class_key(s) if len(s) else None for s in sets], pa.int64()))
            yield kept

    return _placed(docs).mapInArrow(run, T.StructType([*docs.schema.fields, *([T.StructField(key_name, T.LongType())] if key_name else [])]))


def _class_texts(docs: DataFrame, wanted: DataFrame, n: int) -> DataFrame:
    """``cls, text`` of the wanted classes (``cls``, ``doc_id`` of one document with it).

    A bitmap drops nearly all other documents before their texts are shuffled.
    """
    shared = docs.sparkSession.sparkContext.broadcast(_bitmap(wanted))

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHash()
        for whole in batches:
            keep = _hits(shared.value, whole.column(2))
            if not keep.any():
                continue
            batch = whole.filter(pa.array(keep))
            key = []
            for text in batch.column(1):
                s = shingle_set(text.as_py(), known, n)
                key.append(class_key(s) if len(s) else None)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(key, pa.int64()), batch.column(1)], names=["doc_id", "cls", "text"])

    found = _placed(docs.select("doc_id", "text")).mapInArrow(run, "doc_id long, cls long, text string")
    found, wanted = found.alias("f"), small(wanted).alias("w")
    same = (F.col("f.cls") == F.col("w.cls")) & F.col("f.doc_id").eqNullSafe(F.col("w.doc_id"))
    return found.join(wanted, same).select("f.cls", "f.text")


def _verify(pairs: DataFrame, texts: DataFrame, n: int, percent: int) -> DataFrame:
    """The pairs (``a``, ``b``) of classes that are linked."""

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHash()
        last, mine = None, None
        for batch in batches:
            keep = []
            for a, text_a, text_b in zip(batch.column(0).to_pylist(), batch.column(2), batch.column(3)):
                if a != last:
                    last, mine = a, shingle_set(text_a.as_py(), known, n)
                keep.append(linked(mine, shingle_set(text_b.as_py(), known, n), percent))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    with_b = small(pairs.select("a", "b")).join(texts.select(F.col("cls").alias("b"), F.col("text").alias("text_b")), "b")
    both = with_b.join(texts.select(F.col("cls").alias("a"), F.col("text").alias("text_a")), "a")
    return shipped(both).select("a", "b", "text_a", "text_b").mapInArrow(run, "a long, b long")


def near_duplicate_classes(docs: DataFrame, n: int = SHINGLE, percent: int = PERCENT) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(documents with size and class, classes with their least ``doc_id``, ``node, label`` of linked classes)."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    both = materialize(_sets(docs, n), "sets")
    sets = both.where("hits is null").select("doc_id", "n_shingles", "cls")
    order = _order(both.where("hits is not null"))
    classes = materialize(sets.where("cls is not null").groupBy("cls").agg(F.min("doc_id").alias("doc_id")), "classes")

    shared = _shared(_prefixes(docs, order, n, percent), order)
    members = _second_prefixes(shared, percent)
    wanted = materialize(members.select("cls").distinct().join(classes, "cls"), "wanted")
    texts = materialize(_class_texts(docs, wanted, n), "class-texts")
    now = members
    done = links = texts.select(F.col("cls").alias("a"), F.col("cls").alias("b")).where(F.lit(False))
    labels = None
    for turn in range(STAR_TURNS):
        if turn == 0:
            pairs = _may_link_pairs(members.where("lead.cls <> cls").select(F.col("lead").alias("a"), F.struct(*FIELDS).alias("b")), percent)
        else:
            pairs = _star_pairs(now, turn, percent).join(done, ["a", "b"], "left_anti")
        pairs = materialize(pairs, "pairs")
        found = materialize(_verify(pairs, texts, n, percent), "links")
        done, links = done.union(pairs), links.union(found)
        any_found = bool(found.take(1))
        if any_found or labels is None:
            labels = components(links)
        now = materialize(_with_components(now, labels), "members")
        if not any_found or not now.take(1):
            break
    if now.take(1):
        blocks = materialize(_blocks(now), "blocks")
        pairs = materialize(_block_pairs(now, blocks, percent), "pairs")
        found = materialize(_block_links(pairs, blocks, texts, n, percent), "links")
        if found.take(1):
            labels = components(links.union(found))
    return sets, classes, labels


def jaccard_components(docs: DataFrame, n: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """``doc_id, n_shingles, component_id`` for every row of ``docs`` (``doc_id``, ``text``; other columns are ignored).

    ``component_id`` is the smallest ``doc_id`` that links lead to, the row's own included. A
    null or blank text has an empty set and is alone. Rows with equal texts are linked,
    repeated rows too; a null id counts only where no row of the component has one. An empty
    table gives no rows.
    """
    sets, classes, labels = near_duplicate_classes(docs, n, percent)
    named = materialize(_labelled(classes, labels), "named")
    by_class = grouped(named, "label", component_id=F.min("doc_id")).select("cls", "component_id")
    by_class = materialize(by_class, "class-components")
    out = sets.join(by_class, "cls").select("doc_id", "n_shingles", "component_id")
    return out.unionByName(sets.where("cls is null").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id")))


def _labelled(classes: DataFrame, labels: DataFrame) -> DataFrame:
    """``classes`` with ``label``: the component's, or the class itself."""
    return classes.join(labels.withColumnRenamed("node", "cls"), "cls", "left").withColumn("label", F.coalesce("label", "cls"))


def drop_near_duplicates(docs: DataFrame, n: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """One document of each component, that with the smallest ``doc_id``; all columns are kept.

    Every row is judged by its own text: rows with equal ids and texts that aren't linked all
    stay, and a row without an id goes if it is linked to one that has an id. Of rows with
    equal ids and equal shingles any one stays. Texts without words are linked with nothing
    and stay. An empty table gives none; names of other columns don't matter.
    """
    sets, _, labels = near_duplicate_classes(docs, n, percent)
    pairs = sets.where("cls is not null").groupBy("cls", "doc_id").agg(F.count("*").alias("rows"))
    pairs = materialize(_labelled(pairs, labels), "pairs")
    best = F.min(F.struct(F.col("doc_id").isNull().alias("_bare"), "doc_id", "cls"))
    judged = grouped(pairs, "label", "_rows > 1", _rows=F.sum("rows"), _best=best)
    stays = F.col("_best.doc_id").eqNullSafe(F.col("doc_id")) & (F.col("_best.cls") == F.col("cls"))
    judged = judged.select("cls", "doc_id", "rows", stays.alias("stays")).where("not stays or rows > 1")
    names = {x: free_name(docs.columns, x) for x in ("_class", "_of", "_id", "_stays")}
    judged = judged.select(F.col("cls").alias(names["_of"]), F.col("doc_id").alias(names["_id"]), F.col("stays").alias(names["_stays"]))
    judged = materialize(judged, "judged")
    bits = _bitmap(judged.select(F.col(names["_id"]).alias("doc_id")))  # most texts that stay are told by it, and needn't be shuffled
    asked = _by_bitmap(docs, bits, True, names["_class"], n)
    same = (F.col(names["_class"]) == F.col(names["_of"])) & F.col("doc_id").cast("long").eqNullSafe(F.col(names["_id"]))
    out = _by_bitmap(docs, bits, False).unionByName(asked.join(small(judged), same, "left_anti").select(*docs.columns))
    once = judged.where(names["_stays"])
    if once.take(1):
        repeated = asked.join(small(once), same, "left_semi").dropDuplicates(["doc_id", names["_class"]])
        out = out.unionByName(repeated.select(*docs.columns))
    return out


def op2_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(read_table(spark, sf_dir, "documents"))
