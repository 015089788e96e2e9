"""Queries on alignments: flags, scores, CIGAR and MD, ties, counts."""

from __future__ import annotations

from pyspark.sql import functions as F

from strandlake.functions import align
from strandlake.operators import alignments as al
from strandlake.plans.registry import query
from strandlake.plans.views import sql, view

FIRST_TIE = "ties AS (SELECT qname, alt, min(weight) AS weight, min(as_score) AS as_score, min(n_junctions) AS n_junctions, 36 AS read_length FROM v_ties GROUP BY qname, alt)"


def _ties(spark, sf):
    rows = view(spark, sf, "v_ties").groupBy("qname", "alt")
    return rows.agg(F.min("weight").alias("weight"), F.min("as_score").alias("as_score"), F.min("n_junctions").alias("n_junctions"), F.min("read_length").alias("read_length"))


@query("flag_filter", sql("SELECT qname, alt, flag FROM v_alignments WHERE (flag & 4) = 0 AND (flag & 256) = 0", "v_alignments"))
def flag_filter(spark, sf):
    f = F.col("flag")
    return view(spark, sf, "v_alignments").where(~align.has_flag(f, align.UNMAPPED) & ~align.has_flag(f, align.SECONDARY)).select("qname", "alt", "flag")


@query("flag_set_clear", sql("SELECT qname, alt, flag & ~256 AS prim, flag | 256 AS sec, xor(flag, 16) AS flipped FROM v_alignments", "v_alignments"))
def flag_set_clear(spark, sf):
    f = F.col("flag")
    return view(spark, sf, "v_alignments").select("qname", "alt", align.set_primary(f).alias("prim"), align.set_secondary(f).alias("sec"), align.flip_strand(f).alias("flipped"))


@query("softclip_filter", sql("SELECT qname, alt, cigar FROM v_alignments WHERE coalesce(TRY_CAST(regexp_extract(cigar, '^(\\d+)S', 1) AS INT), 0) >= 6 OR coalesce(TRY_CAST(regexp_extract(cigar, '(\\d+)S$', 1) AS INT), 0) >= 6", "v_alignments"))
def softclip_filter(spark, sf):
    return view(spark, sf, "v_alignments").where(align.passes_clip_filter(F.col("cigar"), align.clip_filter_size("mild"))).select("qname", "alt", "cigar")


@query("clip_fraction_filter", sql("SELECT qname, alt FROM v_alignments WHERE coalesce(TRY_CAST(regexp_extract(cigar, '^(\\d+)S', 1) AS INT), 0) / 32.0 < 0.2", "v_alignments"))
def clip_fraction_filter(spark, sf):
    return view(spark, sf, "v_alignments").where(align.clipped_share(F.col("cigar"), F.length("seq")) < 0.2).select("qname", "alt")


@query("exact_match", sql("SELECT qname, alt FROM v_alignments WHERE nm = 0 AND NOT contains(cigar, 'S')", "v_alignments"))
def exact_match(spark, sf):
    return view(spark, sf, "v_alignments").where(align.is_exact(F.col("nm"), F.col("cigar"))).select("qname", "alt")


@query("unique_alignment", sql("SELECT qname, alt, coalesce(xs_score + CAST(round(6 * 32 / 100.0) AS INT) < as_score, true) AS uniq FROM v_alignments", "v_alignments"))
def unique_alignment(spark, sf):
    return view(spark, sf, "v_alignments").select("qname", "alt", align.is_unique(F.col("as_score"), F.col("xs_score"), F.length("seq"), 6).alias("uniq"))


@query("cigar_parse", sql("""
SELECT qname, alt, i - 1 AS place, right(t, 1) AS op, CAST(left(t, length(t) - 1) AS INT) AS size FROM (
  SELECT qname, alt, unnest(t) AS t, unnest(generate_series(1, len(t))) AS i FROM (SELECT qname, alt, regexp_extract_all(cigar, '\\d+[MINDS]') AS t FROM v_alignments))""", "v_alignments"))
def cigar_parse(spark, sf):
    rows = view(spark, sf, "v_alignments").select("qname", "alt", F.posexplode(align.cigar_ops(F.col("cigar"))).alias("place", "o"))
    return rows.select("qname", "alt", F.col("place").cast("bigint").alias("place"), "o.op", "o.size")


@query("md_parse", sql("""
SELECT qname, alt, array_to_string([x FOR x IN regexp_extract_all(md, '\\^+|[A-Za-z]+|\\d+') IF x <> '0'], ' ') AS tokens FROM v_alignments""", "v_alignments"))
def md_parse(spark, sf):
    return view(spark, sf, "v_alignments").select("qname", "alt", F.array_join(align.md_tokens(F.col("md")), " ").alias("tokens"))


DECOMPOSED = """
ops AS (SELECT rid, qname, alt, pos, seq, unnest(t) AS t, unnest(generate_series(1, len(t))) AS i FROM (SELECT *, row_number() OVER () AS rid, regexp_extract_all(cigar, '\\d+[MINDS]') AS t FROM v_alignments)),
sized AS (SELECT *, right(t, 1) AS op, CAST(left(t, length(t) - 1) AS BIGINT) AS size FROM ops),
placed AS (SELECT *, pos + coalesce(sum(CASE WHEN op IN ('M','D','N') THEN size ELSE 0 END) OVER w, 0) AS ref,
                  coalesce(sum(CASE WHEN op IN ('M','I','S') THEN size ELSE 0 END) OVER w, 0) AS rd FROM sized
           WINDOW w AS (PARTITION BY rid ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))"""


@query("cigar_decompose", sql(f"""WITH {DECOMPOSED},
m AS (SELECT *, CASE WHEN ref = lag(ref + size) OVER (PARTITION BY rid ORDER BY i) THEN 0 ELSE 1 END AS fresh FROM placed WHERE op IN ('M', 'D')),
g AS (SELECT *, sum(fresh) OVER (PARTITION BY rid ORDER BY i) AS run FROM m)
SELECT qname, alt, 'exon' AS kind, CAST(min(ref) AS BIGINT) AS start, CAST(max(ref + size) AS BIGINT) AS end_pos FROM g GROUP BY rid, qname, alt, run
UNION ALL SELECT qname, alt, 'junction', CAST(ref AS BIGINT), CAST(ref + size AS BIGINT) FROM placed WHERE op = 'N'
UNION ALL SELECT qname, alt, concat('insertion ', substr(seq, CAST(rd + 1 AS INT), CAST(size AS INT))), CAST(ref - 1 AS BIGINT), CAST(ref - 1 AS BIGINT) FROM placed WHERE op = 'I'""", "v_alignments"))
def cigar_decompose(spark, sf):
    rows = view(spark, sf, "v_alignments").withColumn("ops", align.placed_ops(F.col("cigar"), F.col("pos")))
    exon = rows.select("qname", "alt", F.explode(align.exons(F.col("ops"))).alias("x")).select("qname", "alt", F.lit("exon").alias("kind"), "x.start", "x.end_pos")
    junction = rows.select("qname", "alt", F.explode(align.junctions(F.col("ops"), F.length("seq"))).alias("x")).select("qname", "alt", F.lit("junction").alias("kind"), "x.start", "x.end_pos")
    ins = rows.select("qname", "alt", F.explode(align.insertions(F.col("ops"), F.col("seq"))).alias("x")).select(
        "qname", "alt", F.concat(F.lit("insertion "), "x.seq").alias("kind"), F.col("x.pos").alias("start"), F.col("x.pos").alias("end_pos")
    )
    return exon.unionByName(junction).unionByName(ins)


@query("md_mismatches", sql("""
SELECT qname, alt, pos + 5 AS at, substr(seq, 6, 1) AS base FROM v_alignments WHERE alt % 5 = 0
UNION ALL SELECT qname, alt, pos + 33, substr(seq, 32, 1) FROM v_alignments WHERE alt % 5 = 2
UNION ALL SELECT qname, alt, pos + 6, substr(seq, 7, 1) FROM v_alignments WHERE alt % 5 = 0""", "v_alignments"))
def md_mismatches(spark, sf):
    rows = view(spark, sf, "v_alignments").withColumn("ops", align.placed_ops(F.col("cigar"), F.col("pos")))
    found = rows.select("qname", "alt", F.explode(align.mismatches(F.col("ops"), F.col("md"), F.col("seq"))).alias("x"))
    return found.select("qname", "alt", F.col("x.pos").alias("at"), "x.base")


@query("d_to_m", sql("SELECT qname, alt, translate(cigar, 'D', 'M') AS cigar FROM v_alignments", "v_alignments"))
def d_to_m(spark, sf):
    return view(spark, sf, "v_alignments").select("qname", "alt", F.translate("cigar", "D", "M").alias("cigar"))


@query("second_best", sql(f"WITH {FIRST_TIE} SELECT qname, max(as_score) FILTER (WHERE r = 1) AS best, max(as_score) FILTER (WHERE r = 2) AS second FROM (SELECT *, row_number() OVER (PARTITION BY qname ORDER BY as_score DESC, alt) AS r FROM ties) GROUP BY qname", "v_ties"))
def second_best(spark, sf):
    return al.second_best(_ties(spark, sf))


@query("tie_candidates", sql(f"WITH {FIRST_TIE} SELECT qname, alt, as_score FROM (SELECT *, max(as_score) OVER (PARTITION BY qname) AS best FROM ties) WHERE as_score >= best - CAST(round(4 * 36 / 100.0) AS INT)", "v_ties"))
def tie_candidates(spark, sf):
    return al.tie_candidates(_ties(spark, sf), 4).select("qname", "alt", "as_score")


@query("weighted_tie_break", sql(f"""WITH {FIRST_TIE},
few AS (SELECT * FROM (SELECT *, min(n_junctions) OVER (PARTITION BY qname) AS f FROM ties) WHERE n_junctions = f),
cand AS (SELECT * FROM (SELECT *, max(as_score) OVER (PARTITION BY qname) AS best FROM few) WHERE f > 0 OR as_score = best),
raw AS (SELECT *, CASE WHEN f = 0 THEN 1 ELSE weight END AS w0 FROM cand),
w AS (SELECT *, CASE WHEN sum(w0) OVER (PARTITION BY qname) = 0 THEN 1 ELSE w0 END AS w1 FROM raw),
c AS (SELECT *, sum(w1) OVER (PARTITION BY qname ORDER BY alt ROWS UNBOUNDED PRECEDING) AS hi, sum(w1) OVER (PARTITION BY qname) AS total FROM w)
SELECT qname, alt FROM c WHERE ('0x' || substr(md5(CAST(qname AS VARCHAR)), 1, 8))::BIGINT % total < hi AND ('0x' || substr(md5(CAST(qname AS VARCHAR)), 1, 8))::BIGINT % total >= hi - w1""", "v_ties"))
def weighted_tie_break(spark, sf):
    return al.break_ties(_ties(spark, sf)).select("qname", "alt")


@query("topk_per_read", sql(f"WITH {FIRST_TIE} SELECT qname, alt, as_score, n_junctions FROM (SELECT *, rank() OVER (PARTITION BY qname ORDER BY as_score DESC, n_junctions) AS r FROM ties) WHERE r <= 2", "v_ties"))
def topk_per_read(spark, sf):
    return al.top_k(_ties(spark, sf), 2).select("qname", "alt", "as_score", "n_junctions")


@query("nh_count", sql(f"WITH {FIRST_TIE} SELECT qname, alt, count(*) OVER (PARTITION BY qname) AS nh FROM ties", "v_ties"))
def nh_count(spark, sf):
    return al.with_nh(_ties(spark, sf)).select("qname", "alt", "nh")


COUNTS = """
counts AS (SELECT sample, CASE WHEN (flag & 4) <> 0 THEN '*' ELSE rname END AS rname, count(*) AS total,
  count(*) FILTER (WHERE (flag & 4) <> 0 OR coalesce(xs_score < as_score, true)) AS "unique" FROM v_alignments WHERE (flag & 256) = 0 GROUP BY ALL)"""


@query("read_counts", sql(f"WITH {COUNTS} SELECT * FROM counts", "v_alignments"))
def read_counts(spark, sf):
    return al.read_counts(view(spark, sf, "v_alignments"))


_CELL = lambda c: f"concat(coalesce(max(total) FILTER (WHERE rname = '{c}'), 0), ',', coalesce(max(\"unique\") FILTER (WHERE rname = '{c}'), 0))"


@query("read_count_pivot", sql(f"""WITH {COUNTS}
SELECT sample_label, {_CELL('A')} AS "reads_A", {_CELL('N')} AS "reads_N", {_CELL('R')} AS "reads_R", {_CELL('*')} AS reads_unmapped,
  concat(coalesce(CAST(sum(total) FILTER (WHERE rname <> '*') AS BIGINT), 0), ',', coalesce(CAST(sum("unique") FILTER (WHERE rname <> '*') AS BIGINT), 0)) AS mapped
FROM v_samples LEFT JOIN counts ON sample = sample_index GROUP BY sample_label""", "v_alignments", "v_samples"))
def read_count_pivot(spark, sf):
    return al.count_matrix(al.read_counts(view(spark, sf, "v_alignments")), view(spark, sf, "v_samples"), ["A", "N", "R"])


@query("reads_with_fragment", sql("SELECT qname, alt FROM v_alignments a WHERE EXISTS (SELECT 1 FROM v_called c WHERE c.rname = a.rname AND c.start = a.pos - a.pos % 10 AND c.sample = a.sample)", "v_alignments", "v_called"))
def reads_with_fragment(spark, sf):
    return _by_fragment(spark, sf, "left_semi")


@query("reads_without_fragment", sql("SELECT qname, alt FROM v_alignments a WHERE NOT EXISTS (SELECT 1 FROM v_called c WHERE c.rname = a.rname AND c.start = a.pos - a.pos % 10 AND c.sample = a.sample)", "v_alignments", "v_called"))
def reads_without_fragment(spark, sf):
    return _by_fragment(spark, sf, "left_anti")


def _by_fragment(spark, sf, how):
    a = view(spark, sf, "v_alignments").withColumn("start", F.col("pos") - F.col("pos") % 10)
    return a.join(view(spark, sf, "v_called"), ["rname", "start", "sample"], how).select("qname", "alt")


@query("order_consistent_pairs", sql("""
SELECT a.qname, a.alt AS alt_a, b.alt AS alt_b FROM v_alignments a JOIN v_alignments b ON a.qname = b.qname AND a.alt < b.alt AND a.rname = b.rname AND (a.flag & 16) = (b.flag & 16)
WHERE ((a.nm = b.nm) = (a.pos = b.pos)) AND (a.nm = b.nm OR (a.nm < b.nm) = (a.pos < b.pos))""", "v_alignments"))
def order_consistent_pairs(spark, sf):
    a, b = view(spark, sf, "v_alignments").alias("a"), view(spark, sf, "v_alignments").alias("b")
    c = F.col
    on = (c("a.qname") == c("b.qname")) & (c("a.rname") == c("b.rname")) & (c("a.alt") < c("b.alt")) & (c("a.flag").bitwiseAND(F.lit(16)) == c("b.flag").bitwiseAND(F.lit(16)))
    same = c("a.nm") == c("b.nm")
    fits = (same == (c("a.pos") == c("b.pos"))) & (same | ((c("a.nm") < c("b.nm")) == (c("a.pos") < c("b.pos"))))
    return a.join(b, on).where(fits).select("a.qname", c("a.alt").alias("alt_a"), c("b.alt").alias("alt_b"))


@query("longest_chain", sql("""
WITH RECURSIVE hits AS (SELECT DISTINCT qname, rname, flag & 16 AS s, pos, alt AS d FROM v_alignments),
chain AS (SELECT qname, rname, s, pos, d, 1 AS n FROM hits UNION ALL
  SELECT h.qname, h.rname, h.s, h.pos, h.d, c.n + 1 FROM chain c JOIN hits h ON h.qname = c.qname AND h.rname = c.rname AND h.s = c.s AND h.pos > c.pos AND h.d > c.d)
SELECT qname, CAST(max(n) AS BIGINT) AS size FROM chain GROUP BY qname""", "v_alignments").replace("WITH v_alignments", "WITH RECURSIVE v_alignments").replace("RECURSIVE hits", "hits"))
def longest_chain(spark, sf):
    from strandlake.operators.chains import longest_chains

    hits = view(spark, sf, "v_alignments").select("qname", "rname", F.col("flag").bitwiseAND(F.lit(16)).alias("reverse"), "pos", F.col("alt").alias("disp")).distinct()
    return longest_chains(hits, ["qname"]).select("qname", "size")


# Hits ranked by a hash; each joins the first pivot next to it, or becomes one.
CLUSTERS = """
numbered AS (SELECT *, row_number() OVER (PARTITION BY read_id ORDER BY rname, reverse, pos, end_pos, disp, piece) AS place FROM v_hits),
near AS (SELECT *, coalesce(lag(place) OVER w, 0) AS prior, coalesce(lead(place) OVER w, 1000000) AS next,
  row_number() OVER (PARTITION BY read_id ORDER BY md5(concat_ws(':', CAST(read_id AS VARCHAR), rname, CAST(reverse AS VARCHAR), CAST(pos AS VARCHAR), CAST(end_pos AS VARCHAR), CAST(disp AS VARCHAR), CAST(piece AS VARCHAR)))) AS k
  FROM numbered WINDOW w AS (PARTITION BY read_id, piece ORDER BY place)),
pairs AS (SELECT p.read_id, p.place AS pivot, p.k AS pk, x.place, x.k FROM near p JOIN near x ON p.read_id = x.read_id AND p.k < x.k AND p.rname = x.rname AND p.reverse = x.reverse AND p.piece <> x.piece
  WHERE (p.disp = x.disp) = (p.pos = x.pos) AND (p.disp = x.disp OR (p.disp < x.disp) = (p.pos < x.pos))
  AND CASE WHEN p.place < x.place THEN p.next > x.place AND x.prior < p.place ELSE x.next > p.place AND p.prior < x.place END),
around AS (SELECT n.read_id, n.k, n.place, coalesce(list(pairs.pivot ORDER BY pk) FILTER (WHERE pairs.pivot IS NOT NULL), []) AS earlier
  FROM near n LEFT JOIN pairs ON pairs.read_id = n.read_id AND pairs.place = n.place GROUP BY n.read_id, n.k, n.place),
walk AS (SELECT read_id, k, place, place AS cluster, [place] AS pivots FROM around WHERE k = 1 UNION ALL
  SELECT read_id, k, place, coalesce(own, place), CASE WHEN own IS NULL THEN list_append(pivots, place) ELSE pivots END
  FROM (SELECT a.read_id, a.k, a.place, w.pivots, list_filter(a.earlier, lambda e: list_contains(w.pivots, e))[1] AS own FROM walk w JOIN around a ON a.read_id = w.read_id AND a.k = w.k + 1)),
clustered AS (SELECT n.*, walk.cluster FROM numbered n JOIN walk USING (read_id, place))"""


@query("pivot_clusters", sql(f"WITH {CLUSTERS.strip()} SELECT read_id, CAST(place AS INT) AS place, CAST(cluster AS INT) AS cluster, rname, reverse, pos, end_pos, disp, piece FROM clustered", "v_hits").replace("WITH v_hits", "WITH RECURSIVE v_hits", 1))
def pivot_clusters(spark, sf):
    from strandlake.operators.chains import pivot_clusters as clusters

    return clusters(view(spark, sf, "v_hits"), ["read_id"])


@query("unique_chains", sql(f"""WITH {CLUSTERS.strip()},
spots AS (SELECT read_id, cluster, disp, pos, count(*) AS n FROM clustered GROUP BY ALL),
chain AS (SELECT read_id, cluster, disp, pos, n, [concat(disp, ':', pos)] AS path FROM spots UNION ALL
  SELECT c.read_id, c.cluster, s.disp, s.pos, c.n + s.n, list_append(c.path, concat(s.disp, ':', s.pos)) FROM chain c JOIN spots s ON s.read_id = c.read_id AND s.cluster = c.cluster AND s.disp > c.disp AND s.pos > c.pos),
top AS (SELECT * FROM (SELECT *, max(n) OVER (PARTITION BY read_id) AS most FROM chain) WHERE n = most),
sole AS (SELECT read_id, any_value(cluster) AS cluster, any_value(path) AS path FROM top GROUP BY read_id HAVING count(*) = 1)
SELECT c.read_id, c.rname, c.reverse, c.pos, c.end_pos, c.disp, c.piece FROM clustered c JOIN sole s ON c.read_id = s.read_id AND c.cluster = s.cluster AND list_contains(s.path, concat(c.disp, ':', c.pos))""", "v_hits").replace("WITH v_hits", "WITH RECURSIVE v_hits", 1))
def unique_chains(spark, sf):
    from strandlake.operators.chains import selected_hits

    return selected_hits(view(spark, sf, "v_hits"), ["read_id"])


@query("lift_over", sql("""
WITH a AS MATERIALIZED (SELECT *, row_number() OVER () AS rid, exon1 AS b1, exon1 + exon2 AS b2, least(shift, exon1 + exon2 + 20) AS "from", regexp_extract_all(cigar, '([0-9]+)[A-Z]', 1) AS ns, regexp_extract_all(cigar, '[0-9]+([A-Z])', 1) AS os FROM v_lifted),
ops AS (SELECT rid, b1, b2, intron1, intron2, "from", i, CAST(ns[i] AS BIGINT) AS n, os[i] AS op FROM (SELECT *, unnest(generate_series(1, len(ns))) AS i FROM a)),
units AS (SELECT *, unnest(generate_series(1, n)) AS u FROM ops),
spots AS (SELECT *, "from" + coalesce(count(*) FILTER (WHERE op IN ('M', 'D')) OVER (PARTITION BY rid ORDER BY i, u ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS here FROM units),
put AS (SELECT rid, i, u, 1 AS o, op, 1 AS n FROM spots UNION ALL
  SELECT rid, i, u, 0, 'N', CASE WHEN here = b1 THEN intron1 ELSE intron2 END FROM spots WHERE op IN ('M', 'D') AND here > "from" AND (here = b1 OR here = b2)),
marked AS (SELECT *, CASE WHEN lag(op) OVER w = op THEN 0 ELSE 1 END AS fresh FROM put WINDOW w AS (PARTITION BY rid ORDER BY i, u, o)),
runs AS (SELECT *, sum(fresh) OVER (PARTITION BY rid ORDER BY i, u, o) AS run FROM marked),
summed AS (SELECT rid, run, any_value(op) AS op, CAST(sum(n) AS BIGINT) AS n FROM runs GROUP BY rid, run),
texts AS (SELECT rid, string_agg(concat(n, op), '' ORDER BY run) AS genome_cigar FROM summed GROUP BY rid HAVING count(*) FILTER (WHERE op = 'N') > 0)
SELECT a.read_id, a.alt, a.start + a."from" + CASE WHEN a."from" >= b1 THEN intron1 ELSE 0 END + CASE WHEN a."from" >= b2 THEN intron2 ELSE 0 END AS genome_pos, genome_cigar
FROM a JOIN texts USING (rid)""", "v_lifted"))
def lift_over(spark, sf):
    from strandlake.operators.introns import lift_over as lifted

    c = F.col
    rows = view(spark, sf, "v_lifted").select(
        "read_id", "alt", "start", F.array("exon1", "exon2", F.lit(80).cast("bigint")).alias("exons"), F.array(c("intron1").cast("bigint"), c("intron2").cast("bigint")).alias("introns"),
        F.least("shift", c("exon1") + c("exon2") + 20).alias("from"), "cigar",
    )
    return lifted(rows, "start", "exons", "introns", "from", "cigar").where("genome_cigar is not null").select("read_id", "alt", "genome_pos", "genome_cigar")


@query("clipped_slices", sql("""
WITH genome AS (SELECT rname, concat(string_agg(bases, '' ORDER BY chunk), repeat('N', 1000)) AS g FROM v_reference GROUP BY rname),
a AS (SELECT *, CAST(regexp_extract(cigar, '^([0-9]+)S', 1) AS BIGINT) AS clip FROM v_alignments WHERE cigar LIKE '%S%')
SELECT qname, alt, rname, pos, cigar, concat(repeat('N', CAST(greatest(clip - pos + 1, 0) AS INT)), substr(g, greatest(pos - clip, 1), clip - greatest(clip - pos + 1, 0))) AS left_bases, '' AS right_bases
FROM (SELECT DISTINCT qname, alt, rname, pos, cigar, clip FROM a) JOIN genome USING (rname)""", "v_alignments", "v_reference"))
def clipped_slices(spark, sf):
    from strandlake.operators.intervals import clipped_slices as sliced

    rows = view(spark, sf, "v_alignments").select("qname", "alt", "rname", "pos", "cigar").distinct()
    keyed = rows.withColumnsRenamed({"rname": "contig"}).withColumn("rname", F.col("contig")).withColumn("at", F.col("pos")).withColumn("ops", F.col("cigar"))
    found = sliced(keyed, view(spark, sf, "v_reference"), 32, ["qname", "alt", "contig", "at", "ops"])
    return found.withColumnsRenamed({"contig": "rname", "at": "pos", "ops": "cigar"})
