"""Paths through graphs of introns.

Runs that a read piece can lie across are grown inside cells of a contig, in ``runs``, so what
is shuffled are introns and never runs. Other paths, and runs of cells that don't have all they
need, are found by joins that add one edge at a time. Steps end by the data: a path's bases are bounded by a span, or its introns ascend. What a
step finds is written to the shared scratch folder, so plans stay short and lost work is
done again from there.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strandlake.operators.dataflow import union_all
from strandlake.operators.intervals import direct_successors, fragments
from strandlake.operators.runs import AROUND, CELL, Cell, Rules
from strandlake.session import shipped, written

NUMBERS = ("left_ext", "right_ext", "left_avail", "right_avail")


def intron_configurations(introns: DataFrame, keys: Sequence[str], size: int = 35, min_overlap: int = 9, edge_span: int = 2, min_edge_span_size: int = 25, columns: Sequence[str] | None = None) -> DataFrame:
    """Runs of neighbouring introns that a read piece of ``size`` bases can lie across, per ``keys`` (start, end_pos).

    A run grows along the edges of the intron graph while the exonic bases inside of it are
    fewer than ``size - 1``. It is complete where an edge would reach that many, or without
    an edge to follow. Runs of which ``edge_span`` edges in a row have fewer than
    ``min_edge_span_size`` bases are dropped.

    Gives ``starts``, ``ends``, how far a fragment extends to the left and right, and the exonic
    bases there up to the farthest intron before the run and to the one behind (null without). ``columns``
    names those wanted, the rows then being distinct in them; starts and ends must be among them.

    Cells need the introns up to ``runs.AROUND`` positions off. Where one needs others, or an intron
    without a bound is there, joins over all edges give the cell's runs.
    """
    keys, wanted = list(keys), [*keys, "starts", "ends", *NUMBERS] if columns is None else list(columns)
    nodes, cells, rules, outer = _laid_out(introns, keys, size, min_overlap, edge_span, min_edge_span_size, wanted)
    schema = [f for f in nodes.schema if f.name in wanted and f.name in keys]
    text = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in schema), "starts array<bigint>", "ends array<bigint>", *(f"{c} bigint" for c in NUMBERS if c in wanted)])
    seeds, cells = _opened(nodes, cells, keys, outer, rules)
    found = _in_cells(cells, outer, rules, text).select(*wanted)
    if seeds is None:
        return found
    return found.unionByName(_joined(seeds, nodes.distinct(), keys, size - 1, min_overlap, edge_span, min_edge_span_size).select(*wanted).distinct())


def configuration_fragments(introns: DataFrame, chunks: DataFrame, chunk_size: int, keys: Sequence[str], size: int = 35, min_overlap: int = 9, edge_span: int = 2, min_edge_span_size: int = 25) -> DataFrame:
    """``intervals.fragments`` of all ``intron_configurations`` whatever their keys but rname, each once, on the strand +.

    A cell's part of the reference goes to it, so neither runs nor their bases are shuffled.
    """
    keys = list(keys)
    header = ["rname", "strand", "start", "exon_sizes", "intron_sizes", "sequence"]
    nodes, cells, rules, outer = _laid_out(introns, keys, size, min_overlap, edge_span, min_edge_span_size, ["rname", "starts", "ends", "left_ext", "right_ext"], chunks, chunk_size)
    seeds, cells = _opened(nodes, cells, keys, outer, rules)
    made = _in_cells(cells, outer, rules, "rname string, start bigint, exon_sizes array<bigint>, intron_sizes array<bigint>, sequence string")
    found = made.withColumn("strand", F.lit("+")).select(*header)
    if seeds is None:
        return found
    rest = _joined(seeds, nodes.distinct(), keys, size - 1, min_overlap, edge_span, min_edge_span_size)
    rest = rest.select("rname", F.lit("+").alias("strand"), "starts", "ends", "left_ext", "right_ext").distinct()
    return found.unionByName(fragments(rest, chunks, chunk_size))


def _laid_out(introns: DataFrame, keys: list[str], size: int, min_overlap: int, edge_span: int, least: int, wanted: list[str], chunks: DataFrame | None = None, chunk_size: int = 0):
    """The introns, the same in all cells that must know them, the rules, and the keys that cells are made by."""
    merged = not set(keys) <= set(wanted)
    outer = [k for k in keys if k in wanted] if merged else keys[:1]
    inner = [k for k in keys if k not in outer]
    rules = Rules(size - 1, min_overlap, edge_span, least, tuple(inner), merged, tuple(c for c in NUMBERS if c in wanted), chunk_size)
    number = lambda c: F.col(c).cast("bigint").alias(c)
    nodes = written(introns.select(*keys, number("start"), number("end_pos")), "introns")
    cells = F.explode(F.sequence(F.floor((F.col("start") - AROUND) / CELL), F.floor((F.greatest("start", "end_pos") + AROUND) / CELL))).alias("_cell")
    placed = nodes.where("start is not null and end_pos is not null").select("*", cells)
    if chunks is not None:
        empty = [F.lit(None).cast(nodes.schema[k].dataType).alias(k) for k in inner]
        first = (F.col("chunk") * chunk_size).cast("bigint")
        pieces = chunks.select("rname", *empty, first.alias("start"), (first + chunk_size).alias("end_pos"), "bases").where("bases is not null").select("*", cells)
        placed = placed.withColumn("bases", F.lit(None).cast("string")).unionByName(pieces)
    return nodes, placed, rules, outer


def _opened(nodes: DataFrame, cells: DataFrame, keys: list[str], outer: list[str], rules: Rules) -> tuple[DataFrame | None, DataFrame]:
    """Introns whose runs need others than their cell has (None where there are none), and the cells without theirs."""
    def look(table: pa.Table) -> pa.Table:
        return Cell(table, tuple(outer), rules).open()

    text = ", ".join([*(f"`{k}` {nodes.schema[k].dataType.simpleString()}" for k in [*outer, *rules.inner]), "_cell bigint", "lo bigint", "hi bigint"])
    asked = written(shipped(cells).groupBy(*outer, "_cell").applyInArrow(look, text), "open-cells")
    reach = nodes.groupBy(*keys).agg(F.max("start").alias("_last"), F.min("end_pos").alias("_first"))
    more = asked.where("lo is null and hi is null").select(*outer, "_cell").unionByName(
        asked.join(reach.hint("merge"), keys).where("_last >= hi or _first < lo").select(*outer, "_cell")).distinct()
    more = written(more, "open-cells")
    own = nodes.withColumn("_cell", F.floor(F.col("start") / CELL))
    if not more.take(1):
        odd = nodes.where("start is null or end_pos is null")
        return (odd if odd.take(1) else None), cells
    on = lambda a: [a[c].eqNullSafe(more[c]) for c in [*outer, "_cell"]]
    seeds = own.join(more, on(own), "left_semi").drop("_cell").unionByName(nodes.where("start is null or end_pos is null"))
    return seeds, cells.withColumn("_open", F.lit(False)).unionByName(more.withColumn("_open", F.lit(True)), allowMissingColumns=True)


def _in_cells(cells: DataFrame, outer: list[str], rules: Rules, schema: str) -> DataFrame:
    """Runs of every cell that isn't marked as open."""
    marked = "_open" in cells.columns

    def grow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(batches)
        if marked:
            if True in table.column("_open").unique().to_pylist():
                return
            table = table.drop_columns(["_open"])
        for made in Cell(table, tuple(outer), rules).runs():
            yield from made.combine_chunks().to_batches(max_chunksize=10_000)

    return shipped(cells).groupBy(*outer, "_cell").applyInArrow(grow, schema)


def _joined(seeds: DataFrame, nodes: DataFrame, keys: list[str], reach: int, min_overlap: int, edge_span: int, min_edge_span_size: int) -> DataFrame:
    """Runs that begin with one of ``seeds``, by joins of all runs with all edges."""
    edges = written(direct_successors(nodes, keys, min_overlap).withColumn("gap", F.col("b_start") - F.col("a_end")), "edges")
    out_of = edges.withColumnsRenamed({"a_start": "start", "a_end": "end_pos"})
    walk = seeds.distinct().select(
        *keys, "start", "end_pos", F.array("start").alias("starts"), F.array("end_pos").alias("ends"),
        F.array().cast("array<bigint>").alias("gaps"), F.lit(0).cast("bigint").alias("bases"),
    )
    complete = []
    last_gaps = F.slice(F.concat("gaps", F.array("gap")), -edge_span, edge_span)
    tight = (F.size("gaps") + 1 >= edge_span) & (F.aggregate(last_gaps, F.lit(0).cast("bigint"), lambda a, x: a + x) < min_edge_span_size)
    while True:
        # a run without an edge keeps its row with a null gap
        step = written(walk.join(out_of, [*keys, "start", "end_pos"], "left"), "walk")
        ends_here = F.col("gap").isNull() | (F.col("bases") + F.col("gap") >= reach)
        complete.append(step.where(ends_here).select(*keys, "starts", "ends", "gap"))
        walk = step.where(~ends_here & ~tight).select(
            *keys, F.col("b_start").alias("start"), F.col("b_end").alias("end_pos"), F.concat("starts", F.array("b_start")).alias("starts"),
            F.concat("ends", F.array("b_end")).alias("ends"), F.concat("gaps", F.array("gap")).alias("gaps"), (F.col("bases") + F.col("gap")).alias("bases"),
        )
        if not walk.take(1):
            break
    before = edges.groupBy(*keys, "b_start", "b_end").agg(F.max("gap").alias("left_avail")).withColumnsRenamed({"b_start": "_start", "b_end": "_end"})
    runs = union_all(*complete).withColumn("_start", F.col("starts")[0]).withColumn("_end", F.col("ends")[0]).join(before, [*keys, "_start", "_end"], "left")
    left = F.coalesce("left_avail", F.col("_start") - F.greatest(F.col("_start") - reach, F.lit(1)))
    return runs.select(
        *keys, "starts", "ends", F.least(F.lit(reach), left).alias("left_ext"), F.least(F.lit(reach), "gap").cast("bigint").alias("right_ext"),
        "left_avail", F.col("gap").alias("right_avail"),
    ).distinct()


def inner_bases(starts: Column, ends: Column) -> Column:
    """Exonic bases between the introns of a run."""
    gaps = F.zip_with(F.slice(starts, F.lit(2), F.size(starts)), F.slice(ends, F.lit(1), F.size(ends) - 1), lambda s, e: s - e)
    return F.aggregate(gaps, F.lit(0).cast("bigint"), lambda a, x: a + x)


def combined_runs(cojunctions: DataFrame, span: int, most: int | None = 300, keys: Sequence[str] = ("read", "rname_strand")) -> DataFrame:
    """Runs of introns that ``span`` bases can lie across, per read, contig and strand (``starts``, ``ends``).

    A run is followed by any run behind it, neither touching nor overlapping, if the bases
    inside both and between them fit into the span with one more at either end. Chains of runs
    that nothing comes before and nothing behind are joined end to end; runs that stand alone
    or in the middle of a chain count by themselves. Each result counts also without its first
    intron, its last, or both. A read's only run stays as it is.

    At most ``most`` results per read are kept, those with the fewest introns, ties in an order
    set by a hash; None keeps all.
    """
    keys = list(keys)
    runs = written(cojunctions.select(*keys, "starts", "ends").where(F.size("starts") > 0).distinct(), "runs")
    nodes = runs.withColumn("low", F.col("starts")[0]).withColumn("high", F.element_at("ends", -1)).withColumn("inside", inner_bases(F.col("starts"), F.col("ends")))
    cell = lambda c: F.floor(F.col(c) / max(1, span))  # noqa: E731  what follows begins at most a span behind
    a = nodes.select(*keys, F.struct("starts", "ends").alias("a"), "high", F.col("inside").alias("a_inside"), F.explode(F.array(cell("high"), cell("high") + 1)).alias("_cell"))
    b = nodes.select(*keys, F.struct("starts", "ends").alias("b"), "low", F.col("inside").alias("b_inside"), cell("low").alias("_cell"))
    fits = (F.col("low") > F.col("high")) & (F.col("low") - F.col("high") + F.col("a_inside") + F.col("b_inside") + 2 <= span)
    edges = written(a.join(b, [*keys, "_cell"]).where(fits).select(*keys, "a", "b"), "run-edges")
    before, behind = (edges.select(*keys, F.col(x).alias("run")).distinct() for x in "ab")
    sources, sinks = before.join(behind, [*keys, "run"], "left_anti"), behind.join(before, [*keys, "run"], "left_anti")
    whole = [runs.select(*keys, F.struct("starts", "ends").alias("run")).join(sources.unionByName(sinks), [*keys, "run"], "left_anti").select(*keys, "run.starts", "run.ends")]
    next_ones = edges.join(sinks.select(*keys, F.col("run").alias("b"), F.lit(True).alias("at_end")), [*keys, "b"], "left")
    next_ones = written(next_ones.select(*keys, F.col("a").alias("last"), "b", F.coalesce("at_end", F.lit(False)).alias("at_end")), "run-steps")
    chain = sources.select(*keys, F.col("run").alias("last"), "run.starts", "run.ends")
    while True:
        step = chain.join(next_ones, [*keys, "last"]).select(
            *keys, F.col("b").alias("last"), F.concat("starts", "b.starts").alias("starts"), F.concat("ends", "b.ends").alias("ends"), "at_end")
        step = written(step, "chains")
        if not step.take(1):
            break
        whole.append(step.where("at_end").select(*keys, "starts", "ends"))
        chain = step.where("not at_end").drop("at_end")
    alone = runs.groupBy(*keys).agg(F.count("*").alias("_n"))
    n = F.size("starts")
    part = lambda first, size: F.struct(*(F.slice(c, F.lit(first), F.greatest(size, F.lit(0))).alias(c) for c in ("starts", "ends")))
    parts = F.when(F.col("_n") > 1, F.array(part(1, n), part(2, n - 1), part(1, n - 1), part(2, n - 2))).otherwise(F.array(part(1, n)))
    found = union_all(*whole).join(alone, keys).select(*keys, F.explode(parts).alias("run")).select(*keys, "run.starts", "run.ends").where(F.size("starts") > 0).distinct()
    if most is None:
        return found
    order = Window.partitionBy(*keys).orderBy(F.size("starts"), F.md5(F.concat_ws(";", F.col(keys[0]).cast("string"), F.array_join("starts", ","), F.array_join("ends", ","))))
    return found.withColumn("_r", F.row_number().over(order)).where(F.col("_r") <= most).drop("_r")
