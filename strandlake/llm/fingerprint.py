"""Document fingerprints: a homomorphic multiset hash over paragraphs.

Paragraphs end at line ends, and in long lines at sentence ends too. A text's fingerprint is the sum of vectors of its paragraphs, so it doesn't depend on their
order, and paragraphs are inserted or deleted by adding or subtracting their vectors. A vector
has two parts, and both are added in the same way:

* The wide part has 1,036 lanes modulo 2^4, fourteen to a long. A paragraph's lanes are all drawn
  from its SHA-256 digest, each long by a hash of its own of it. Equality rests on them: with
  4,144 bits, to look for unlike sets of paragraphs with equal sums among lists of them
  (generalized birthday) takes some 2^128 steps.
* The counting part serves likeness. A paragraph is cut into phrases, by what they end with or
  else by length, and each phrase has a sign, +1 or -1, in each of 240 lanes. Lanes hold how
  many phrases have +1, modulo 2^15, four to a long, and the last long holds how many there are.
  (A lane that is full carries 1 to its neighbour, as the longs are sums modulo 2^60.)

The mean product of two texts' signed sums estimates the number of phrases that they share,
whatever the texts' lengths, as signs of unlike phrases cancel out. Twice that over the sum of
the means of their squares is the likeness. Its standard error is 1/15 at most.

Everything is DataFrame functions: arrays inside a row, no row per paragraph, no Python.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Longs of the wide part, and hashes of 60 signs in the counting part.
WIDE, SIGNS = 74, 4
WIDE_LANES = 14
LANE_LOW, LANE_HIGH = 0x77777777777777, 0x88888888888888
WIDE_MASK = LANE_LOW | LANE_HIGH
LANE_BITS = 15
ONES = sum(1 << (LANE_BITS * k) for k in range(4))
COUNT_MASK = (1 << (4 * LANE_BITS)) - 1
#: Lines of more code points than this are cut at sentence ends.
LONG_LINE = 400
SENTENCE_END = "(?<=[.!?]) "
#: Paragraphs of more code points than this are cut into phrases, and phrases of more than twice as many into equal lengths.
LONG = 60
PHRASE_END = "(?<=[.!?gk,;:、，。]) "
EQUAL_LENGTHS = "(?s).{1,%d}" % LONG
#: Documents in a block of ascending ids that one task sorts to find each document's next.
BLOCK_DOCS = 2_000
MOST_BLOCKS = 10_000


def let(value: Column, f) -> Column:
    """``f(value)`` with ``value`` computed once."""
    return F.get(F.transform(F.array(value), f), 0)


def paragraphs(text: Column) -> Column:
    lines = F.transform(F.split(text, "\n"), lambda x: F.when(F.length(x) > LONG_LINE, F.split(x, SENTENCE_END)).otherwise(F.array(x)))
    return F.flatten(lines)


def phrases(paragraph: Column) -> Column:
    """A paragraph's phrases; what they are depends on the paragraph only."""
    by_length = lambda p: F.when(F.length(p) > 2 * LONG, F.regexp_extract_all(p, F.lit(EQUAL_LENGTHS), F.lit(0))).otherwise(F.array(p))
    return F.when(F.length(paragraph) > LONG, F.flatten(F.transform(F.split(paragraph, PHRASE_END), by_length))).otherwise(F.array(paragraph))


def _lanes_sum(a: Column, b: Column) -> Column:
    """Lane by lane modulo 2^4; no carry leaves a lane, and no long its 56 bits."""
    return (a.bitwiseAND(F.lit(LANE_LOW)) + b.bitwiseAND(F.lit(LANE_LOW))).bitwiseXOR(a.bitwiseXOR(b).bitwiseAND(F.lit(LANE_HIGH)))


def wide_part(found: Column) -> Column:
    """Sums of the wide vectors of an array of paragraphs."""
    def summed(digests):
        def lane(i):
            values = F.transform(digests, lambda d: F.xxhash64(d, i).bitwiseAND(F.lit(WIDE_MASK)))
            return F.aggregate(values, F.lit(0).cast("bigint"), _lanes_sum)

        return F.transform(F.sequence(F.lit(1), F.lit(WIDE)), lane)

    return let(F.transform(found, lambda p: F.unhex(F.sha2(p, 256))), summed)


def counting_part(found: Column) -> Column:
    """Sums of the signs of an array of paragraphs' phrases, and their number."""
    def summed(parts):
        def signs(k):
            def lanes(values):
                count = lambda j: F.aggregate(
                    values, F.lit(0).cast("bigint"),
                    lambda total, x: (total + F.call_function("shiftrightunsigned", x, j).bitwiseAND(F.lit(ONES))).bitwiseAND(F.lit(COUNT_MASK)),
                )
                return F.transform(F.sequence(F.lit(0), F.lit(LANE_BITS - 1)), count)

            return let(F.transform(parts, lambda p: F.xxhash64(p, k)), lanes)

        return F.concat(F.flatten(F.transform(F.sequence(F.lit(1), F.lit(SIGNS)), signs)), F.array(F.size(parts).cast("bigint")))

    return let(F.flatten(F.transform(found, phrases)), summed)


def fingerprint(found: Column) -> Column:
    """``wide`` and ``counts`` of an array of paragraphs."""
    return let(found, lambda f: F.struct(wide_part(f).alias("wide"), counting_part(f).alias("counts")))


def combine(a: Column, b: Column, sign: int = 1) -> Column:
    """Fingerprint of two texts' paragraphs together (``sign`` 1), or of the first's without the second's (-1)."""
    counts = F.zip_with(a["counts"], b["counts"], lambda x, y: (x + F.lit(sign) * y).bitwiseAND(F.lit(COUNT_MASK)))
    if sign == 1:
        wide = F.zip_with(a["wide"], b["wide"], _lanes_sum)
    else:  # in each lane, what is missing from 2^4 is added
        one = F.lit(0x11111111111111)
        wide = F.zip_with(a["wide"], b["wide"], lambda x, y: _lanes_sum(_lanes_sum(x, y.bitwiseXOR(F.lit(WIDE_MASK))), one))
    return F.struct(wide.alias("wide"), counts.alias("counts"))


def as_text(f: Column) -> Column:
    """Hex of the wide longs, then of the counting ones."""
    words = lambda a, n: F.array_join(F.transform(a, lambda x: F.lpad(F.lower(F.hex(x)), n, "0")), "")
    return F.concat(words(f["wide"], 14), F.lit(":"), words(f["counts"], 16))


def _signed(counts: Column) -> Column:
    """Signed sums of the lanes, between -2^15 and 2^15, which is far more than the root of any number of phrases."""
    longs, half = LANE_BITS * SIGNS, 1 << LANE_BITS
    n = F.get(counts, longs)

    def lanes(x):
        ones = F.transform(F.sequence(F.lit(0), F.lit(3 * LANE_BITS), F.lit(LANE_BITS)), lambda j: F.call_function("shiftrightunsigned", x, j).bitwiseAND(F.lit(half - 1)))
        return F.transform(ones, lambda o: (F.pmod(2 * o - n + half, F.lit(2 * half)) - half).cast("double"))

    return F.flatten(F.transform(F.slice(counts, 1, longs), lanes))


def likeness(a: Column, b: Column) -> Column:
    """1 for equal fingerprints, else about twice the shared phrases over all of both, from 0 to below 1."""
    add = lambda total, x: total + x
    zero = F.lit(0.0)
    product = lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: p * q), zero, add)
    share = lambda x, y: 2 * product(x, y) / F.greatest(product(x, x) + product(y, y), F.lit(1.0))
    estimate = let(_signed(a["counts"]), lambda x: let(_signed(b["counts"]), lambda y: share(x, y)))
    return F.when(a == b, F.lit(1.0)).otherwise(F.greatest(F.least(estimate, F.lit(0.999)), zero))


def edited_fingerprint(own: Column, before: Column, after: Column) -> Column:
    """``own``, the fingerprint of the paragraphs ``before``, brought to ``after``.

    What changes behind their common start is deleted and inserted, or, if that is more
    paragraphs than ``after`` has, its fingerprint is made anew.
    """
    def changed(before, after):
        same = F.array_position(F.zip_with(before, after, lambda x, y: x.eqNullSafe(y)), F.lit(False))  # the first that differs, from 1; 0 if none

        def brought(at):
            rest = lambda a: F.when(at > 0, F.slice(a, at, F.greatest(F.size(a) - at + 1, F.lit(0)))).otherwise(F.slice(a, 1, F.lit(0)))
            out, new = fingerprint(rest(before)), fingerprint(rest(after))
            by_steps = let(F.struct(out.alias("out"), new.alias("new")), lambda x: combine(combine(own, x["out"], -1), x["new"]))
            less = F.size(rest(before)) + F.size(rest(after)) < F.size(after)
            return F.when(less, by_steps).otherwise(fingerprint(after))

        return let(same.cast("int"), brought)

    return let(before, lambda x: let(after, lambda y: changed(x, y)))


def _block(least: Column, tie: Column, bounds: list[int]) -> Column:
    """Which of the ascending ``bounds`` is the last not above ``least``, counted from 1; 0 before the first.

    Bounds are looked up in two steps. A value that is a bound several times is dealt over as
    many blocks, by ``tie``, a hash.
    """
    step = max(1, int(len(bounds) ** 0.5))
    groups = [bounds[i : i + step] for i in range(0, len(bounds), step)]
    heads = F.from_json(F.lit(json.dumps([g[0] for g in groups])), "array<bigint>")  # folded to constants
    nested = F.from_json(F.lit(json.dumps(groups)), "array<array<bigint>>")

    def below(test):
        group = F.size(F.filter(heads, test))
        return F.when(group == 0, F.lit(0)).otherwise((group - 1) * step + F.size(F.filter(F.get(nested, group - 1), test)))

    lower, upper = below(lambda b: b < least), below(lambda b: b <= least)
    share = F.floor((tie / F.lit(2.0**64) + 0.5) * (upper - lower)).cast("int")
    return F.when(upper - lower > 1, lower + 1 + F.least(F.greatest(share, F.lit(0)), upper - lower - 1)).otherwise(upper)


def in_blocks(docs: DataFrame, block_docs: int = BLOCK_DOCS) -> tuple[DataFrame, Window]:
    """``docs`` (``doc_id``, ``text``) with a number ``block`` that ascends with ``doc_id``, and the window over a block in order.

    Order is by ``doc_id``, nulls first, then a hash of the text, then the text. Bounds are
    approximate quantiles; an id or null that many rows share is dealt over several blocks.
    """
    blocks = max(1, min(MOST_BLOCKS, docs.count() // block_docs))
    least = F.coalesce("doc_id", F.lit(-(2**63)))
    bounds = []
    if blocks > 1:
        row = docs.agg(F.percentile_approx(least, [i / blocks for i in range(1, blocks)], MOST_BLOCKS).alias("q")).first()
        bounds = sorted(row["q"] or [])
    tie = F.xxhash64("text")
    block = _block(least, tie.cast("double"), bounds) if bounds else F.lit(0)
    order = [F.col("doc_id").asc_nulls_first(), tie, F.col("text")]
    return docs.withColumn("block", block), Window.partitionBy("block").orderBy(*order)


def fingerprint_documents(docs: DataFrame, block_docs: int = BLOCK_DOCS) -> DataFrame:
    """Fingerprints of every whole text and of its edited text, and their likeness.

    The edited text has its last floor(n/4) code points replaced by the first as many, or
    all, of the next document (ascending ``doc_id``, nulls first, equal ids by a hash of the
    text; after the last, the first). A null text is empty; a single document is its own next.
    Repeated rows are documents of their own. Other columns are ignored whatever their names;
    every input row gives one row; an empty table gives none.

    Documents are dealt into blocks of ascending ids and each block is sorted on its own. A
    block's last document takes the first of the next block, of which there is one row per
    block. Only texts are shuffled; a text's fingerprint is made once, in its block, and passed
    on to the document before it.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    dealt, window = in_blocks(docs, block_docs)
    order = F.struct(F.col("doc_id").isNotNull().alias("known"), "doc_id", F.xxhash64("text").alias("tie"))
    first = dealt.groupBy("block").agg(F.min(order).alias("first"))  # MOST_BLOCKS rows at most; keys only, no texts
    heads = dealt.join(F.broadcast(first), "block").where(order.eqNullSafe(F.col("first"))).groupBy("block").agg(F.min("text").alias("head"))
    chain = Window.orderBy("block")  # a row per block
    whole = chain.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    heads = heads.select("block", F.coalesce(F.lead("head").over(chain), F.first("head").over(whole)).alias("head"))
    heads = heads.withColumn("head_own", fingerprint(paragraphs(F.col("head"))))
    rows = dealt.withColumn("next", F.lead("text").over(window)).withColumn("own", fingerprint(paragraphs(F.col("text"))))
    rows = rows.withColumn("next_own", F.lead("own").over(window)).withColumn("last", F.col("next").isNull())
    rows = rows.join(heads.withColumnRenamed("block", "of"), (F.col("block") == F.col("of")) & F.col("last"), "left")
    n = F.length("text")
    q = F.floor(n / 4).cast("int")
    after = F.coalesce("next", "head")
    rows = rows.select("doc_id", "text", "own", F.coalesce("next_own", "head_own").alias("next_own"), n.cast("long").alias("n_chars"), F.concat(
        F.substring(F.col("text"), F.lit(1), n - q), F.substring(after, F.lit(1), q)).alias("edited"))
    rows = rows.withColumn("new", edited_fingerprint(F.col("own"), paragraphs(F.col("text")), paragraphs(F.col("edited"))))
    return rows.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), as_text(F.col("own")).alias("fingerprint"), as_text(F.col("new")).alias("edited_fingerprint"),
        likeness(F.col("own"), F.col("new")).alias("near_edited"), likeness(F.col("own"), F.col("next_own")).alias("near_next"),
    )


def with_fingerprint(rows: DataFrame, text: str, name: str) -> DataFrame:
    """Adds ``name``, the fingerprint of the column ``text``, in place of a column of that name; a null text is empty."""
    return rows.withColumn(name, fingerprint(paragraphs(F.coalesce(F.col(text), F.lit("")))))


def op4_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"))
