"""Queries on sequences, qualities, pieces of reads and the reference."""

from __future__ import annotations

from pyspark.sql import functions as F

from strandlake.functions import seq as sq
from strandlake.operators import alignments as al
from strandlake.operators import intervals as iv
from strandlake.plans.registry import query
from strandlake.plans.views import sql, view

RC = "translate(reverse({0}), 'ATCG', 'TAGC')"
CANON = "canon AS (SELECT qname, qual, sample, CASE WHEN seq < " + RC.format("seq") + " THEN seq ELSE " + RC.format("seq") + " END AS canon_seq, NOT (seq < " + RC.format("seq") + ") AS is_reversed FROM v_reads)"


def _canon(spark, sf):
    canon, flipped = sq.canonical(F.col("seq"))
    return view(spark, sf, "v_reads").select("qname", "qual", "sample", canon.alias("canon_seq"), flipped.alias("is_reversed"))


@query("revcomp", sql(f"SELECT qname, {RC.format('seq')} AS rc FROM v_reads", "v_reads"))
def revcomp(spark, sf):
    return view(spark, sf, "v_reads").select("qname", sq.revcomp(F.col("seq")).alias("rc"))


@query("canonical_reads", sql(f"WITH {CANON} SELECT qname, canon_seq, is_reversed FROM canon", "v_reads"))
def canonical_reads(spark, sf):
    return _canon(spark, sf).select("qname", "canon_seq", "is_reversed")


@query("sanitize_ascii", "SELECT c_custkey, regexp_replace(upper(c_name), '[^ATCGN]', 'N', 'g') AS clean FROM customer")
def sanitize_ascii(spark, sf):
    from strandlake.plans.views import table

    return table(spark, sf, "customer").select("c_custkey", sq.sanitize(F.col("c_name")).alias("clean"))


@query("quality_bin", sql("SELECT qname, array_to_string([substr('#05Hh', 1 + 4 * least(ord(c) - 33, 40) // 40, 1) FOR c IN string_split(qual, '')], '') AS binned FROM v_reads", "v_reads"))
def quality_bin(spark, sf):
    return view(spark, sf, "v_reads").select("qname", sq.bin_qualities(F.col("qual")).alias("binned"))


@query("phred64_convert", sql("SELECT qname, array_to_string([chr(least(greatest(ord(c), 64), 104) - 31) FOR c IN string_split(qual64, '')], '') AS sanger FROM v_reads", "v_reads"))
def phred64_convert(spark, sf):
    return view(spark, sf, "v_reads").select("qname", sq.phred64_to_sanger(F.col("qual64")).alias("sanger"))


@query("phred_infer", sql("""
SELECT 'qual64' AS field, CASE WHEN min(ord(c)) >= 64 THEN 'Phred64' WHEN min(ord(c)) < 59 THEN 'Sanger' WHEN max(ord(c)) >= 94 THEN 'Solexa' ELSE 'Sanger' END AS encoding
FROM (SELECT unnest(string_split(qual64, '')) AS c FROM v_reads)
UNION ALL SELECT 'qual', CASE WHEN min(ord(c)) >= 64 THEN 'Phred64' WHEN min(ord(c)) < 59 THEN 'Sanger' WHEN max(ord(c)) >= 94 THEN 'Solexa' ELSE 'Sanger' END
FROM (SELECT unnest(string_split(qual, '')) AS c FROM v_reads)""", "v_reads"))
def phred_infer(spark, sf):
    reads = view(spark, sf, "v_reads")
    part = lambda c: reads.agg(F.min(F.array_min(sq.codes(F.col(c)))).alias("lo"), F.max(F.array_max(sq.codes(F.col(c)))).alias("hi")).select(F.lit(c).alias("field"), sq.phred_format(F.col("lo"), F.col("hi")).alias("encoding"))
    return part("qual64").union(part("qual"))


@query("polya_filter", sql("""
SELECT qname FROM (SELECT qname, concat(substr(seq, 1, CAST(qname % 9 AS INT)), repeat('A', 20)) AS s FROM v_reads)
WHERE regexp_matches(substr(s, 1, length(s) - 8), '^(A*|T*)$') OR regexp_matches(substr(s, 9), '^(A*|T*)$')""", "v_reads"))
def polya_filter(spark, sf):
    padded = F.concat(F.substring(F.col("seq"), F.lit(1), (F.col("qname") % 9).cast("int")), F.lit("A" * 20))
    return view(spark, sf, "v_reads").where(sq.is_poly(padded, 9)).select("qname")


@query("read_length_minmax", sql("SELECT sample, min(length(seq) - qname % 7) AS shortest, max(length(seq) - qname % 7) AS longest FROM v_reads GROUP BY sample", "v_reads"))
def read_length_minmax(spark, sf):
    n = F.length("seq") - F.col("qname") % 7
    return view(spark, sf, "v_reads").groupBy("sample").agg(F.min(n).alias("shortest"), F.max(n).alias("longest"))


@query("best_quality_rep", sql(f"""
WITH {CANON}, scored AS (SELECT canon_seq, qname, list_sum([ord(c) FOR c IN string_split(qual, '')]) / length(qual) AS mean_qual FROM canon)
SELECT canon_seq, qname, round(mean_qual, 8) AS mean_qual FROM (SELECT *, row_number() OVER (PARTITION BY canon_seq ORDER BY mean_qual DESC, qname DESC) AS r FROM scored) WHERE r = 1""", "v_reads"))
def best_quality_rep(spark, sf):
    return al.best_representatives(_canon(spark, sf)).select("canon_seq", "qname", F.round("mean_qual", 8).alias("mean_qual"))


@query("seq_multiplicity", sql(f"WITH {CANON} SELECT canon_seq, sample, is_reversed, count(*) AS copies FROM canon GROUP BY ALL", "v_reads"))
def seq_multiplicity(spark, sf):
    return al.multiplicity(_canon(spark, sf))


def _readlets(spark, sf):
    pieces = view(spark, sf, "v_reads").select("qname", "seq", F.explode(sq.readlets(F.col("seq"))).alias("p"))
    piece = F.substring(F.col("seq"), F.col("p.start") + 1, F.col("p.size"))
    canon, flipped = sq.canonical(piece)
    return pieces.select("qname", F.col("p.start").alias("disp5"), (F.length("seq") - F.col("p.start") - F.col("p.size")).alias("disp3"), canon.alias("readlet_seq"), flipped.alias("is_reversed"))


PIECES = """
pieces AS (
  SELECT qname, seq, 0 AS start, s AS size FROM v_reads, (SELECT unnest([15,16,17,18,19,20,22,24,25]) AS s) UNION ALL
  SELECT qname, seq, length(seq) - s, s FROM v_reads, (SELECT unnest([15,16,17,18,19,20,22,24,25]) AS s) UNION ALL
  SELECT qname, seq, j, 25 FROM v_reads, (SELECT unnest(generate_series(4, 400, 4)) AS j) WHERE j < length(seq) - 25),
cut AS (SELECT qname, CAST(start AS INT) AS disp5, CAST(length(seq) - start - size AS INT) AS disp3, substr(seq, CAST(start + 1 AS INT), size) AS r FROM pieces)"""


@query("readletize", sql(f"""WITH {PIECES}
SELECT qname, disp5, disp3, CASE WHEN r < {RC.format('r')} THEN r ELSE {RC.format('r')} END AS readlet_seq, NOT (r < {RC.format('r')}) AS is_reversed FROM cut""", "v_reads"))
def readletize(spark, sf):
    return _readlets(spark, sf)


@query("seed_join", sql("""
WITH kmers AS (SELECT rname, chunk * 32 + i AS pos, substr(bases, CAST(i + 1 AS INT), 10) AS kmer FROM v_reference, (SELECT unnest(generate_series(0, 22)) AS i)),
rare AS (SELECT *, count(*) OVER (PARTITION BY kmer) AS n FROM kmers)
SELECT qname, rname, pos FROM v_reads JOIN rare ON substr(seq, 1, 10) = kmer WHERE n <= 30""", "v_reads", "v_reference"))
def seed_join(spark, sf):
    ref = view(spark, sf, "v_reference")
    kmers = ref.select("rname", "chunk", "bases", F.explode(F.sequence(F.lit(0), F.lit(22))).alias("i")).select(
        "rname", (F.col("chunk") * 32 + F.col("i")).alias("pos"), F.substring(F.col("bases"), F.col("i") + 1, F.lit(10)).alias("kmer")
    )
    seeds = view(spark, sf, "v_reads").select("qname", F.substring("seq", 1, 10).alias("kmer"))
    return al.seed_hits(seeds, kmers, 30).select("qname", "rname", "pos")


@query("fanout_duplicates", sql(f"""
WITH {CANON}, firsts AS (SELECT canon_seq, min(qname) AS rep, 16 AS flag FROM canon GROUP BY canon_seq)
SELECT qname, rep, CASE WHEN is_reversed THEN xor(flag, 16) ELSE flag END AS flag FROM canon JOIN firsts USING (canon_seq)""", "v_reads"))
def fanout_duplicates(spark, sf):
    from strandlake.functions.align import flip_strand
    from strandlake.operators.dataflow import distinct_then_fan_out

    canon = _canon(spark, sf)
    firsts = canon.groupBy("canon_seq").agg(F.min("qname").alias("rep")).withColumn("flag", F.lit(16))
    joined = distinct_then_fan_out(canon, "canon_seq", lambda keys: keys.join(firsts, "canon_seq"))
    return joined.select("qname", "rep", F.when(F.col("is_reversed"), flip_strand(F.col("flag"))).otherwise(F.col("flag")).alias("flag"))


@query("get_stretch", sql("""
WITH asked AS (SELECT DISTINCT substr('ANR', CAST(o_orderkey % 3 + 1 AS INT), 1) AS rname, o_custkey * 5 - 40 AS "offset", 20 + o_orderkey % 60 AS size FROM orders),
genome AS (SELECT rname, string_agg(bases, '' ORDER BY chunk) AS g FROM v_reference GROUP BY rname)
SELECT rname, "offset", size,
  rpad(concat(repeat('N', CAST(greatest(0, least(size, -"offset")) AS INT)),
       CASE WHEN "offset" + size > 0 THEN substr(g, CAST(greatest("offset", 0) + 1 AS INT), CAST(greatest(0, "offset" + size - greatest("offset", 0)) AS INT)) ELSE '' END), CAST(size AS INT), 'N') AS seq
FROM asked JOIN genome USING (rname)""", "v_reference"))
def get_stretch(spark, sf):
    from strandlake.plans.views import table

    asked = table(spark, sf, "orders").select(F.expr("substr('ANR', cast(o_orderkey % 3 + 1 as int), 1)").alias("rname"), (F.col("o_custkey") * 5 - 40).alias("offset"), (20 + F.col("o_orderkey") % 60).alias("size")).distinct()
    return iv.stretches(asked, view(spark, sf, "v_reference"), 32).select("rname", "offset", "size", "seq")


@query("nw_score", sql("SELECT a.qname, -levenshtein(a.seq, b.seq) AS score FROM v_reads a JOIN v_reads b ON b.qname = a.qname + 1", "v_reads"))
def nw_score(spark, sf):
    a, b = view(spark, sf, "v_reads").alias("a"), view(spark, sf, "v_reads").alias("b")
    return a.join(b, F.col("b.qname") == F.col("a.qname") + 1).select("a.qname", sq.global_score(F.col("a.seq"), F.col("b.seq")).cast("bigint").alias("score"))


@query("motif_lookup", sql("""
SELECT qname, CASE WHEN concat(l, '-', r) IN ('GT-AG', 'GC-AG', 'AT-AC') THEN '+' WHEN concat(l, '-', r) IN ('CT-AC', 'CT-GC', 'GT-AT') THEN '-' END AS strand
FROM (SELECT qname, substr(seq, 3, 2) AS l, substr(seq, 21, 2) AS r FROM v_reads)""", "v_reads"))
def motif_lookup(spark, sf):
    return view(spark, sf, "v_reads").select("qname", sq.motif_strand(F.substring("seq", 3, 2), F.substring("seq", 21, 2)).alias("strand"))


@query("motif_class_counts", sql("""
SELECT class, count(*) AS n FROM (SELECT CASE WHEN m IN ('GT-AG', 'CT-AC') THEN 'canonical' WHEN m IN ('GC-AG', 'CT-GC') THEN 'less' WHEN m IN ('AT-AC', 'GT-AT') THEN 'much less' ELSE 'other' END AS class
FROM (SELECT concat(substr(seq, 3, 2), '-', substr(seq, 21, 2)) AS m FROM v_reads)) GROUP BY class""", "v_reads"))
def motif_class_counts(spark, sf):
    pair = F.concat_ws("-", F.substring("seq", 3, 2), F.substring("seq", 21, 2))
    kind = F.when(pair.isin("GT-AG", "CT-AC"), "canonical").when(pair.isin("GC-AG", "CT-GC"), "less").when(pair.isin("AT-AC", "GT-AT"), "much less").otherwise("other")
    return view(spark, sf, "v_reads").groupBy(kind.alias("class")).agg(F.count("*").alias("n"))


@query("base36_encode", """
SELECT o_orderkey, concat(
  CASE WHEN o_orderkey >= 1679616 THEN substr('0123456789abcdefghijklmnopqrstuvwxyz', CAST(o_orderkey // 1679616 % 36 + 1 AS INT), 1) ELSE '' END,
  CASE WHEN o_orderkey >= 46656 THEN substr('0123456789abcdefghijklmnopqrstuvwxyz', CAST(o_orderkey // 46656 % 36 + 1 AS INT), 1) ELSE '' END,
  CASE WHEN o_orderkey >= 1296 THEN substr('0123456789abcdefghijklmnopqrstuvwxyz', CAST(o_orderkey // 1296 % 36 + 1 AS INT), 1) ELSE '' END,
  CASE WHEN o_orderkey >= 36 THEN substr('0123456789abcdefghijklmnopqrstuvwxyz', CAST(o_orderkey // 36 % 36 + 1 AS INT), 1) ELSE '' END,
  substr('0123456789abcdefghijklmnopqrstuvwxyz', CAST(o_orderkey % 36 + 1 AS INT), 1)) AS name FROM orders""")
def base36_encode(spark, sf):
    from strandlake.plans.views import table

    return table(spark, sf, "orders").select("o_orderkey", sq.base36(F.col("o_orderkey")).alias("name"))


@query("positional_rate", sql("""
WITH e AS (SELECT qname, seq, unnest(generate_series(0, 31)) AS p FROM v_reads)
SELECT CAST(p AS INT) AS "at", count(*) AS reads, count(*) FILTER (WHERE substr(seq, CAST(p + 1 AS INT), 1) = 'G') AS hits,
       round(count(*) FILTER (WHERE substr(seq, CAST(p + 1 AS INT), 1) = 'G') / count(*), 8) AS rate FROM e GROUP BY p""", "v_reads"))
def positional_rate(spark, sf):
    from strandlake.operators.metrics import positional_rates

    letters = F.split("seq", "")
    hits = F.filter(F.transform(letters, lambda c, i: F.when(c == "G", i)), lambda x: x.isNotNull())
    return positional_rates(view(spark, sf, "v_reads"), hits, F.length("seq")).withColumn("rate", F.round("rate", 8))


@query("suffix_match", sql("""
WITH q AS (SELECT qname, concat('AC', substr(seq, CAST(5 + qname % 3 AS INT), 12)) AS query, concat(substr(seq, 20, 13), seq, reverse(seq)) AS win FROM v_reads),
places AS (SELECT qname, query, win, p FROM (SELECT *, unnest(generate_series(length(query) - 8, length(win) - 8)) AS p FROM q) WHERE substr(win, CAST(p + 1 AS INT), 8) = right(query, 8)),
fine AS (SELECT qname FROM places GROUP BY qname, query HAVING count(*) <= 5 AND min(p) > length(query) - 8),
sizes AS (SELECT qname, p + 8 - k AS "offset", k FROM (SELECT *, unnest(generate_series(8, least(length(query), p + 8))) AS k FROM places) WHERE substr(win, CAST(p + 9 - k AS INT), CAST(k AS INT)) = right(query, CAST(k AS INT))),
best AS (SELECT qname, max(k) AS size FROM sizes GROUP BY qname)
SELECT qname, CAST(min("offset") AS INT) AS "offset", CAST(size AS INT) AS size FROM best JOIN sizes USING (qname) JOIN fine USING (qname) WHERE k = size GROUP BY qname, size""", "v_reads"))
def suffix_match(spark, sf):
    from strandlake.operators.introns import suffix_match as matched

    reads = view(spark, sf, "v_reads").select(
        "qname", F.concat(F.lit("AC"), F.substring("seq", (5 + F.col("qname") % 3).cast("int"), F.lit(12))).alias("query"),
        F.concat(F.substring("seq", 20, 13), "seq", F.reverse("seq")).alias("win"),
    )
    found = reads.select("qname", matched(F.col("query"), F.col("win"), 8).alias("m")).where("m is not null")
    return found.select("qname", F.col("m.offset").alias("offset"), F.col("m.size").alias("size"))


@query("composite_names", sql("""
SELECT qname, concat('q/', qname, chr(29), substr(md5(seq), 1, 8), chr(29), sample) AS name FROM v_reads""", "v_reads"))
def composite_names(spark, sf):
    reads = view(spark, sf, "v_reads")
    return reads.select("qname", sq.composite_name(F.concat(F.lit("q/"), F.col("qname").cast("string")), F.col("seq"), F.col("sample")).alias("name"))


@query("name_parts", sql("""
SELECT qname AS id, concat('q/', qname) AS qname, CASE WHEN sample > 0 THEN substr(md5(seq), 1, 8) END AS mate, sample FROM v_reads""", "v_reads"))
def name_parts(spark, sf):
    mate = F.when(F.col("sample") > 0, F.col("seq"))
    named = view(spark, sf, "v_reads").select(F.col("qname").alias("id"), sq.composite_name(F.concat(F.lit("q/"), F.col("qname").cast("string")), mate, F.col("sample")).alias("name"))
    return named.select("id", sq.name_parts(F.col("name")).alias("p")).select("id", "p.*")


@query("short_names", sql("""
SELECT qname, concat(CASE WHEN r >= 46656 THEN substr(d, CAST(r // 46656 % 36 + 1 AS INT), 1) ELSE '' END, CASE WHEN r >= 1296 THEN substr(d, CAST(r // 1296 % 36 + 1 AS INT), 1) ELSE '' END,
  CASE WHEN r >= 36 THEN substr(d, CAST(r // 36 % 36 + 1 AS INT), 1) ELSE '' END, substr(d, CAST(r % 36 + 1 AS INT), 1), '_', sample) AS name
FROM (SELECT *, qname % 1000000 AS r, '0123456789abcdefghijklmnopqrstuvwxyz' AS d FROM v_reads)""", "v_reads"))
def short_names(spark, sf):
    return view(spark, sf, "v_reads").select("qname", sq.short_name(F.col("qname") % 1_000_000, F.col("sample")).alias("name"))


@query("hash_sample", sql("SELECT qname, seq FROM v_reads ORDER BY md5(CAST(qname AS VARCHAR)), qname LIMIT 1000", "v_reads"))
def hash_sample(spark, sf):
    """A sample of fixed size, which is the operator's feature."""
    from strandlake.operators.dataflow import hash_sample as sampled

    return sampled(view(spark, sf, "v_reads").select("qname", "seq"), "qname", 1_000)
