"""Deterministic views of the star-schema test tables as sequencing relations, in Spark and in SQL.

Each view has one definition as text that both engines read alike, so a query and its SQL
begin at the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

_HEX, _BASES = "0123456789abcdef", "ATCGATCGATCGATCG"
_DNA = f"translate(md5(cast({{}} as string)), '{_HEX}', '{_BASES}')"

#: name -> (tables it reads, definition)
VIEWS: dict[str, tuple[tuple[str, ...], str]] = {
    "v_intervals": (("lineitem",), """
        select l_returnflag as rname, cast(l_suppkey % 5 as int) as sample, l_partkey * 7 + 1 as pos,
               l_partkey * 7 + 1 + cast(l_quantity as bigint) as end_pos, l_discount < 0.05 as uniq,
               substr('ACGTN', cast(l_linenumber % 5 as int) + 1, 1) as base, l_linenumber = 1 as is_ref
        from lineitem"""),
    "v_contigs": (("lineitem",), """
        select l_returnflag as rname, max(l_partkey * 7 + 1 + cast(l_quantity as bigint)) + 100 as length
        from lineitem group by l_returnflag"""),
    "v_reads": (("orders",), f"""
        select o_orderkey as qname, {_DNA.format('o_custkey')} as base_seq,
               case when o_orderkey % 2 = 1 then translate(reverse({_DNA.format('o_custkey')}), 'ATCG', 'TAGC')
                    else {_DNA.format('o_custkey')} end as seq,
               translate(md5(cast(o_orderkey as string)), '{_HEX}', '!#(+05:?BDHIKMOS') as qual,
               translate(md5(cast(o_orderkey as string)), '{_HEX}', '@BCEGJLNPRTVXZ`h') as qual64,
               cast(o_orderkey % 5 as int) as sample
        from orders"""),
    "v_junction_obs": (("lineitem",), """
        select concat(l_returnflag, case when l_linestatus = 'O' then '+' else '-' end) as rname_strand,
               l_partkey * 10 as start, l_partkey * 10 + 60 as end_pos, cast(l_suppkey % 20 as int) as sample,
               cast(sum(l_linenumber) as bigint) as count
        from lineitem group by 1, 2, 3, 4"""),
    "v_indels": (("lineitem",), """
        select case when l_linenumber % 3 = 0 then 'I' when l_linenumber % 3 = 1 then 'D' else 'N' end as type,
               l_returnflag as rname, l_partkey * 10 as start, l_partkey * 10 + 5 as end_pos,
               case when l_linenumber % 3 = 2 then case when l_linestatus = 'O' then '+' else '-' end
                    else substr('ACGTACGT', cast(l_partkey % 4 as int) + 1, 3) end as strand_or_seq,
               cast(l_suppkey % 20 as int) as sample,
               case when l_linenumber % 3 = 2 then cast(l_quantity as int) end as left_disp,
               case when l_linenumber % 3 = 2 then 60 - cast(l_quantity as int) end as right_disp,
               cast(l_linenumber as bigint) as count
        from lineitem"""),
    "v_ties": (("lineitem",), """
        select l_orderkey as qname, l_linenumber as alt, l_suppkey % 7 as weight, -(l_partkey % 4) as as_score,
               cast(l_suppkey % 3 as int) as n_junctions, 36 as read_length
        from lineitem"""),
    "v_alignments": (("lineitem",), f"""
        select l_orderkey as qname, l_linenumber as alt, cast(l_suppkey % 5 as int) as sample, l_returnflag as rname,
               l_partkey * 7 + 1 as pos,
               cast((case when l_linenumber > 1 then 256 else 0 end) + (case when l_linestatus = 'O' then 16 else 0 end)
                    + (case when l_suppkey % 11 = 0 then 4 else 0 end) + (case when l_orderkey % 2 = 0 then 128 else 0 end) as int) as flag,
               case l_linenumber % 5
                 when 0 then '32M'
                 when 1 then concat(cast(8 + l_suppkey % 9 as string), 'M', cast(60 + l_partkey % 90 as string), 'N', cast(24 - l_suppkey % 9 as string), 'M')
                 when 2 then concat(cast(10 + l_suppkey % 7 as string), 'M2D', cast(22 - l_suppkey % 7 as string), 'M')
                 when 3 then concat(cast(9 + l_suppkey % 5 as string), 'M3I', cast(20 - l_suppkey % 5 as string), 'M')
                 else concat(cast(1 + l_suppkey % 12 as string), 'S', cast(31 - l_suppkey % 12 as string), 'M') end as cigar,
               case l_linenumber % 5
                 when 2 then concat(cast(10 + l_suppkey % 7 as string), '^GT', cast(21 - l_suppkey % 7 as string), 'C0')
                 when 0 then '5A0C25' else '29' end as md,
               {_DNA.format('l_partkey')} as seq, cast(-(l_suppkey % 7) as int) as as_score,
               case when l_partkey % 3 = 0 then null else cast(-(l_partkey % 9) as int) end as xs_score,
               cast(l_suppkey % 3 as int) as nm
        from lineitem"""),
    "v_exons": (("lineitem",), """
        select l_orderkey as transcript, l_partkey * 10 as start, l_partkey * 10 + cast(l_quantity as bigint) as end_pos
        from lineitem"""),
    "v_truth": (("lineitem",), """
        select distinct l_returnflag as rname, l_partkey * 10 as start, l_partkey * 10 + 60 as end_pos, cast(l_suppkey % 20 as int) as sample
        from lineitem where l_linenumber % 2 = 0"""),
    "v_called": (("lineitem",), """
        select distinct l_returnflag as rname, l_partkey * 10 as start, l_partkey * 10 + 60 as end_pos, cast(l_suppkey % 20 as int) as sample
        from lineitem where l_linenumber % 2 = 1"""),
    "v_samples": (("nation",), "select cast(n_nationkey as int) as sample_index, n_name as sample_label from nation"),
    "v_introns": (("lineitem",), """
        select distinct l_returnflag as rname, cast(l_suppkey % 5 as int) as sample, l_partkey * 40 as start,
               l_partkey * 40 + 20 + l_suppkey % 50 as end_pos
        from lineitem"""),
    "v_reference": (("part",), f"""
        select rname, cast(p_partkey as bigint) as chunk, translate(md5(concat(rname, cast(p_partkey as string))), '{_HEX}', '{_BASES}') as bases
        from (select 'A' as rname, p_partkey from part union all select 'N', p_partkey from part union all select 'R', p_partkey from part)"""),
    "v_cojunctions": (("lineitem",), """
        select l_orderkey as read, l_returnflag as rname_strand, l_partkey % 40 * 5 + 1 as s1, l_partkey % 40 * 5 + 4 + l_suppkey % 10 as e1,
               case when l_linenumber % 3 = 0 then l_partkey % 40 * 5 + 8 + l_suppkey % 10 + l_suppkey % 7 end as s2,
               case when l_linenumber % 3 = 0 then l_partkey % 40 * 5 + 14 + l_suppkey % 10 + l_suppkey % 7 end as e2
        from lineitem"""),
    "v_hits": (("lineitem",), """
        select distinct l_orderkey as read_id, case when l_suppkey % 5 = 0 then 'R' else 'A' end as rname, l_partkey % 7 = 0 as reverse,
               l_partkey % 50 * 4 + 1 as pos, l_partkey % 50 * 4 + 21 as end_pos, cast(l_linenumber % 4 * 5 as int) as disp, cast(l_linenumber % 4 as int) as piece
        from lineitem"""),
    "v_split_reads": (("orders",), """
        select o_orderkey as read_id, cast(o_orderkey % 5 as int) as sample, substr('ANR', cast(o_custkey % 3 + 1 as int), 1) as rname, o_orderkey % 3 = 0 as reverse,
               o_custkey * 40 + 101 as p, 30 + o_orderkey % 5 as lead, 40 + o_orderkey % 61 as intron, o_orderkey % 4 = 0 as headless, o_orderkey % 7 = 0 as tailless
        from orders"""),
    "v_lifted": (("lineitem",), """
        select l_orderkey as read_id, l_linenumber as alt, l_partkey as start, cast(l_quantity as bigint) as exon1, 15 + l_suppkey % 9 as exon2, 60 + l_linenumber as intron1,
               100 + l_suppkey % 50 as intron2, l_suppkey % 25 as shift,
               case l_linenumber % 4 when 0 then '36M' when 1 then '10M2I24M' when 2 then '5S12M3D16M' else '8M4I9M2D7M6S' end as cigar
        from lineitem"""),
}


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A view as a DataFrame over the tables in ``sf_dir``."""
    tables, text = VIEWS[name]
    frames = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in tables}
    for t in tables:
        text = text.replace(f"from {t}", f"from {{{t}}}")
    return spark.sql(text, **frames)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def sql(text: str, *names: str) -> str:
    """``text`` behind the definitions of the views it reads, for DuckDB."""
    parts = [f"{n} AS ({VIEWS[n][1]})" for n in names]
    own = text.strip()
    if own.lower().startswith("with "):
        return "WITH " + ",\n".join(parts) + ",\n" + own[5:]
    return "WITH " + ",\n".join(parts) + "\n" + own
