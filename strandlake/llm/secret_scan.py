"""Secret scans: fixed patterns, and character Markov models compared by log-likelihood ratio.

Two first-order Markov models over the characters of tokens are trained: one of random
strings (samples made by a rule: hex, base 64 and base 62 of digests of counters), one of
ordinary identifiers (words of a sample of documents, outside what the fixed patterns find).
A run of token characters is reported where the ratio of its likelihoods is high enough.

Everything is DataFrame functions, and the work grows with a text's length: a match's place is
found by adding up the lengths of the gaps that ``split`` leaves and of the matches before it,
in blocks, and characters are looked up in bytes, not by walking the text from its start.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of the base patterns.
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"  # the pattern's matches of 20 characters or more
HEX = r"[0-9a-f]{24,}"  # runs of 24 or more
KINDS = ("assign", "access", "hex", "random")
TOKEN = r"[A-Za-z0-9+/_-]{20,}"

ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-"
SIZE = len(ALPHABET)
#: Pairs of the alphabet's bytes as numbers lie from here to there.
PAIRS_FROM, PAIRS_TO = 257 * min(map(ord, ALPHABET)), 257 * max(map(ord, ALPHABET)) + 1
#: Entries that a running total is made of at once.
BLOCK = 512
#: Documents from which ordinary identifiers are learned, about; and random strings of each form.
SAMPLE_DOCS = 2_000
RANDOM_STRINGS = 3_000
#: Longest word that an ordinary identifier is learned from.
WORD_LENGTH = 64
#: Least log-likelihood ratio (nats) of a reported token, in all and per character.
LEAST_TOTAL, LEAST_MEAN = 20.0, 0.75


def let(value: Column, f) -> Column:
    """``f(value)`` with ``value`` computed once."""
    return F.get(F.transform(F.array(value), f), 0)


def running(values: Column, plus, zero: int = 0) -> Column:
    """Running totals of an array of longs by the associative function ``plus`` of two Columns.

    Totals are made inside blocks and then carried over them, as each step copies what its
    array holds already.
    """
    none = F.array().cast("array<bigint>")
    last = lambda a: F.coalesce(F.get(a, F.size(a) - 1), F.lit(zero).cast("bigint"))
    append = lambda a, x: F.concat(a, F.array(plus(last(a), x)))

    def carried(blocks):
        before = F.aggregate(blocks, F.array(F.lit(zero).cast("bigint")), lambda a, block: append(a, last(block)))
        return F.flatten(F.zip_with(blocks, F.slice(before, F.lit(1), F.size(blocks)), lambda block, c: F.transform(block, lambda x: plus(c, x))))

    def totals(values):
        starts = F.sequence(F.lit(1), F.greatest(F.size(values), F.lit(1)), F.lit(BLOCK))
        blocks = F.transform(starts, lambda b: F.aggregate(F.slice(values, b, F.lit(BLOCK)), none, append))
        return F.when(F.size(values) > BLOCK, let(blocks, carried)).otherwise(F.aggregate(values, none, append))

    return let(values, totals)


SPANS = "array<struct<kind:int,start:bigint,end:bigint,low:bigint,high:bigint,match:string>>"


def spans_of(text: Column, pattern: str, kind: int, value_group: int = 0, least: int = 1) -> Column:
    """Spans of the pattern's matches whose group is long enough.

    ``start`` and ``end`` (exclusive) are in code points, ``low`` and ``high`` in bytes.
    """
    def placed(matches):
        gaps = F.slice(F.split(text, pattern, -1), F.lit(1), F.size(matches))

        def ends(size):
            return running(F.zip_with(gaps, matches, lambda g, m: (size(g) + size(m)).cast("bigint")), lambda a, b: a + b)

        places = F.zip_with(ends(F.length), ends(F.octet_length), lambda e, h: F.struct(e.alias("end"), h.alias("high")))
        return F.zip_with(places, matches, lambda p, m: F.struct(
            F.lit(kind).alias("kind"), (p["end"] - F.length(m)).alias("start"), p["end"].alias("end"),
            (p["high"] - F.octet_length(m)).alias("low"), p["high"].alias("high"), m.alias("match"),
        ))

    found = let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), placed)
    if least > 1:
        values = F.regexp_extract_all(text, F.lit(pattern), F.lit(value_group))
        found = F.filter(F.zip_with(found, values, lambda s, v: F.when(F.length(v) >= least, s)), lambda s: s.isNotNull())
    return F.when(text.rlike(pattern), found.cast(SPANS)).otherwise(F.array().cast(SPANS))


def _bigrams(words: DataFrame) -> dict[tuple[int, int], int]:
    """Counts of neighbouring symbols of the column ``word``: 66 x 66 rows at most."""
    pairs = words.select(
        F.explode(F.transform(F.sequence(F.lit(1), F.length("word") - 1), lambda i: F.substring(F.col("word"), i, F.lit(2)))).alias("pair")
    )
    counts = pairs.groupBy("pair").count().collect()
    return {(ALPHABET.find(r["pair"][0]), ALPHABET.find(r["pair"][1])): r["count"] for r in counts}


def random_strings(spark: SparkSession, n: int = RANDOM_STRINGS) -> DataFrame:
    """Labelled samples of random strings, by a rule: digests of counters in hex, base 64 and letters with digits."""
    digest = F.sha2(F.concat(F.lit("random string "), F.col("id").cast("string")), 256)
    b64 = F.regexp_replace(F.base64(F.unhex(digest)), "=", "")
    forms = F.array(digest, b64, F.regexp_replace(b64, "[+/]", ""), F.translate(b64, "+/", "-_"), F.upper(F.regexp_replace(b64, "[+/]", "")))
    return spark.range(n).select(F.explode(forms).alias("word"))


def ordinary_words(docs: DataFrame, sample_docs: int = SAMPLE_DOCS) -> DataFrame:
    """Words of about ``sample_docs`` documents chosen by a hash of the id, without what the base patterns match.

    Words of more than ``WORD_LENGTH`` characters aren't learned from.
    """
    part = max(1, docs.count() // sample_docs)
    chosen = docs.where(F.pmod(F.xxhash64("doc_id", F.lit(29)), F.lit(part)) == 0)
    text = F.col("text")
    for pattern in (ASSIGN, ACCESS, HEX):
        text = F.regexp_replace(text, pattern, " ")
    return (
        chosen.select(F.explode(F.regexp_extract_all(text, F.lit(r"[A-Za-z0-9+/_-]{4,}"), F.lit(0))).alias("word"))
        .where(F.length("word") <= WORD_LENGTH)
        .where(~F.col("word").rlike("[0-9]") | F.col("word").rlike("^[A-Za-z_-]+[0-9]{1,4}$|^[0-9/-]+$"))
    )


def train(docs: DataFrame, sample_docs: int = SAMPLE_DOCS) -> list[float]:
    """Log ratios of the transition probabilities, random over ordinary, row by row of 66 symbols."""
    spark = docs.sparkSession
    models = []
    for words in (random_strings(spark), ordinary_words(docs, sample_docs)):
        counts = _bigrams(words)
        rows = []
        for a in range(SIZE):
            total = sum(counts.get((a, b), 0) for b in range(SIZE))
            rows.append([math.log((counts.get((a, b), 0) + 0.5) / (total + 0.5 * SIZE)) for b in range(SIZE)])
        models.append(rows)
    return [round(models[0][a][b] - models[1][a][b], 4) for a in range(SIZE) for b in range(SIZE)]


def log_ratio(token: Column, ratios: list[float]) -> Column:
    """Log-likelihood ratio, random over ordinary, of a token's characters after the first. A token is of the alphabet.

    Eight bytes at a time are read as a number, which holds seven neighbouring pairs.
    """
    entries = [0.0] * (PAIRS_TO - PAIRS_FROM)
    for i, a in enumerate(ALPHABET):
        for j, b in enumerate(ALPHABET):
            entries[256 * ord(a) + ord(b) - PAIRS_FROM] = ratios[i * SIZE + j]
    table = F.split(F.lit(",".join(map(str, entries))), ",").cast("array<double>")  # folded to a constant

    def total(raw):
        def step(total, i):
            eight = F.conv(F.rpad(F.hex(F.substring(raw, i, F.lit(8))), 16, "0"), 16, 10).cast("bigint")
            pair = lambda x, k: F.coalesce(F.get(table, (F.shiftright(x, 8 * k).bitwiseAND(F.lit(0xFFFF)) - PAIRS_FROM).cast("int")), F.lit(0.0))
            return total + let(eight, lambda x: sum((pair(x, k) for k in range(1, 7)), pair(x, 0)))

        return F.aggregate(F.sequence(F.lit(1), F.greatest(F.octet_length(raw) - 1, F.lit(1)), F.lit(7)), F.lit(0.0), step)

    return let(token.cast("binary"), total)


def random_spans(text: Column, ratios: list[float]) -> Column:
    """Spans of token runs that the model of random strings explains better."""
    def suspicious(s):
        return let(log_ratio(s["match"], ratios), lambda r: (r >= LEAST_TOTAL) & (r >= LEAST_MEAN * F.length(s["match"])))

    return F.filter(spans_of(text, TOKEN, KINDS.index("random")), suspicious)


def _ordered(spans: Column) -> Column:
    """Spans by start, then kind as listed."""
    fields = ("start", "kind", "end", "low", "high")
    return F.sort_array(F.transform(spans, lambda s: F.struct(*(s[f].alias(f) for f in fields))))


def _free(spans: Column, taken: Column) -> Column:
    """Those of ``spans`` that touch none of ``taken``: what is taken before a span's end must end before its start."""
    none = F.lit(None).cast("struct<start:bigint,kind:int,end:bigint,low:bigint,high:bigint>")
    event = lambda at, order, far, span: F.struct(at.alias("at"), F.lit(order).alias("order"), far.alias("far"), span.alias("span"))
    events = F.sort_array(F.concat(
        F.transform(taken, lambda t: event(t["start"], 1, t["end"], none)),
        F.transform(spans, lambda s: event(s["end"], 0, F.lit(0).cast("bigint"), s)),
    ))

    def free(events):
        reach = running(F.transform(events, lambda e: e["far"]), F.greatest)
        return F.filter(F.zip_with(events, reach, lambda e, far: F.when(far <= e["span"]["start"], e["span"])), lambda s: s.isNotNull())

    return F.when((F.size(spans) == 0) | (F.size(taken) == 0), spans).otherwise(_ordered(let(events, free)))


def _found(docs: DataFrame, ratios: list[float] | None) -> DataFrame:
    """``row`` (all columns as one struct), ``base`` and ``added`` with places in code points and bytes."""
    if ratios is None:
        ratios = train(docs)
    text = F.col("text")
    found = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), F.coalesce("text", F.lit("")).alias("text")).select(
        "row", _ordered(F.concat(spans_of(text, ASSIGN, 0, 2, 6), spans_of(text, ACCESS, 1), spans_of(text, HEX, 2))).alias("base"),
        _ordered(random_spans(text, ratios)).alias("random"),
    )
    return found.select("row", "base", _free(F.col("random"), F.col("base")).alias("added"))


def find_secrets(docs: DataFrame, ratios: list[float] | None = None) -> DataFrame:
    """``docs`` with ``base`` and ``added``: arrays of spans (start, kind, end) by start, then kind as listed.

    ``base`` holds the fixed patterns' spans, ``added`` those of the Markov models that touch
    no base span. A null or empty text has none. Repeated rows and rows with equal or null ids
    are kept as they are; an empty table gives none. Columns of ``docs`` with these two names
    are replaced, whatever other names it has. The work for a text grows with its length.
    """
    plain = lambda spans: F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end")))
    kept = [F.col(f"row.`{c}`") for c in docs.columns if c.lower() not in ("base", "added")]
    return _found(docs, ratios).select(*kept, plain(F.col("base")).alias("base"), plain(F.col("added")).alias("added"))


def spans_text(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    names = F.split(F.lit(",".join(KINDS)), ",")
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ",")


def report(docs: DataFrame, ratios: list[float] | None = None) -> DataFrame:
    """``doc_id``, counts of base spans by kind, ``base_sha256`` and ``spans`` for every row of ``docs``.

    Only ``doc_id`` and ``text`` are read. Rows with equal or null ids are kept; an empty
    table gives no rows.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long")
    return find_secrets(docs, ratios).select(
        "doc_id", *(count(i).alias(f"n_{KINDS[i]}") for i in range(3)),
        F.sha2(spans_text(F.col("base")), 256).alias("base_sha256"),
        spans_text(F.sort_array(F.concat("base", "added"))).alias("spans"),
    )


def redact(docs: DataFrame, mark: str = "[SECRET]", ratios: list[float] | None = None) -> DataFrame:
    """``docs`` with every span, overlapping ones as one, replaced by ``mark``; ``n_chars``, if there, counted anew.

    A null text stays null, and a text without spans stays as it is. All rows stay, repeated
    ones too, with all their columns, whatever those are called; an empty table gives none.
    """
    found = _found(docs, ratios).select("row", _ordered(F.concat("base", "added")).alias("spans"))
    spans = F.col("spans")

    def rewritten(reach, raw):
        before = F.concat(F.array(F.lit(0).cast("bigint")), reach)
        gaps = F.zip_with(spans, F.slice(before, F.lit(1), F.size(spans)), lambda s, low: F.when(s["low"] >= low, F.struct(low.alias("low"), s["low"].alias("high"))))
        gaps = F.concat(F.filter(gaps, lambda g: g.isNotNull()), F.array(F.struct(F.get(reach, F.size(reach) - 1).alias("low"), F.octet_length(raw).cast("bigint").alias("high"))))
        return F.array_join(F.transform(gaps, lambda g: F.substring(raw, (g["low"] + 1).cast("int"), (g["high"] - g["low"]).cast("int")).cast("string")), mark)

    new = let(F.col("row.text").cast("binary"), lambda raw: let(running(F.transform(spans, lambda s: s["high"]), F.greatest), lambda reach: rewritten(reach, raw)))
    text = F.when(F.size("spans") > 0, new).otherwise(F.col("row.text"))
    done = found.select("row", text.alias("text"))
    new = {"text": F.col("text"), "n_chars": F.length("text").cast("long")}
    return done.select(*(new.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns))


def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report(spark.read.parquet(f"{sf_dir}/documents.parquet"))
