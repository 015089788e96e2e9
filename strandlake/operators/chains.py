"""Hits of a read's pieces that belong together: clusters around pivots, and longest chains.

A hit has ``rname``, ``reverse``, ``pos``, ``end_pos``, ``disp`` (how far into the read its piece
begins) and ``piece``. Two hits are consistent if they lie on one strand and read and reference
order agree: equal displacement exactly where the position is equal. All work inside a read is
done by array functions on a row, none in Python.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

HIT = ("rname", "reverse", "pos", "end_pos", "disp", "piece")


def consistent(a: Column, b: Column) -> Column:
    """Whether two hits on one strand are in one order on the read and on the reference."""
    same = a["disp"] == b["disp"]
    return (same == (a["pos"] == b["pos"])) & (same | ((a["disp"] < b["disp"]) == (a["pos"] < b["pos"])))


def pivot_clusters(hits: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``hits`` with ``cluster``: the number of the pivot among the read's hits in reference order, from 1, and their own ``place``.

    Hits are ranked by a hash. In that order a hit joins the first pivot next to it, or becomes
    a pivot itself. Next to each other are consistent hits of different pieces if no hit of
    either piece stands between them in reference order; the nearest hits of one's own piece
    on either side tell that.
    """
    order = [F.col(c) for c in HIT]
    in_read, of_piece = Window.partitionBy(*keys).orderBy(*order), Window.partitionBy(*keys, "piece").orderBy("place")
    named = hits.withColumn("place", F.row_number().over(in_read)).withColumn("_prior", F.lag("place").over(of_piece)).withColumn("_next", F.lead("place").over(of_piece))
    rank = F.md5(F.concat_ws(":", *(F.col(k).cast("string") for k in [*keys, *HIT]))).alias("rank")
    fields = ("place", *HIT, F.coalesce("_prior", F.lit(0)).alias("prior"), F.coalesce("_next", F.lit(2**31 - 1)).alias("next"))
    rows = named.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(rank, *fields))).alias("hits"))

    def near(p, x):
        apart = F.when(p["place"] < x["place"], (p["next"] > x["place"]) & (x["prior"] < p["place"])).otherwise((x["next"] > p["place"]) & (p["prior"] < x["place"]))
        return (p["rname"] == x["rname"]) & (p["reverse"] == x["reverse"]) & (p["piece"] != x["piece"]) & consistent(p, x) & apart

    def assign(state, x):
        first = F.get(F.filter(state["pivots"], lambda p: near(p, x)), 0)["place"]
        own = F.struct(F.coalesce(first, x["place"]).alias("cluster"), *(x[c].alias(c) for c in ("place", *HIT)))
        return F.struct(
            F.when(first.isNull(), F.concat(state["pivots"], F.array(x))).otherwise(state["pivots"]).alias("pivots"),
            F.concat(state["done"], F.array(own)).alias("done"),
        )

    types = {c: hits.schema[c].dataType.simpleString() for c in HIT}
    plain = ",".join(f"{c}:{types[c]}" for c in HIT)
    begin = F.struct(
        F.array().cast(f"array<struct<rank:string,place:int,{plain},prior:int,next:int>>").alias("pivots"),
        F.array().cast(f"array<struct<cluster:int,place:int,{plain}>>").alias("done"),
    )
    done = F.aggregate("hits", begin, assign, lambda s: s["done"])
    return rows.select(*keys, F.explode(done).alias("x")).select(*keys, "x.*")


def longest_chains(hits: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Per ``keys`` the ``size`` of a largest set of mutually consistent hits, how many ``ways`` there are, and one as ``chain`` (disp, pos).

    Consistent hits ascend in both displacement and position, so a largest set is a longest
    chain of places; hits at one place are in it together. ``chain`` also names the strand.
    """
    places = hits.groupBy(*keys, "rname", "reverse", "disp", "pos").agg(F.count("*").alias("n"))
    strands = places.groupBy(*keys, "rname", "reverse").agg(F.array_sort(F.collect_list(F.struct(F.col("disp").cast("bigint").alias("disp"), F.col("pos").cast("bigint").alias("pos"), "n"))).alias("places"))
    chain = "array<struct<disp:bigint,pos:bigint>>"

    def extend(done, x):
        before = F.filter(done, lambda a: (a["disp"] < x["disp"]) & (a["pos"] < x["pos"]))
        most = F.coalesce(F.array_max(F.transform(before, lambda a: a["size"])), F.lit(0).cast("bigint"))
        best = F.filter(before, lambda a: a["size"] == most)
        ways = F.greatest(F.aggregate(best, F.lit(0).cast("bigint"), lambda total, a: total + a["ways"]), F.lit(1).cast("bigint"))
        longest = F.concat(F.coalesce(F.get(best, 0)["chain"], F.array().cast(chain)), F.array(F.struct(x["disp"].alias("disp"), x["pos"].alias("pos"))))
        return F.concat(done, F.array(F.struct(x["disp"].alias("disp"), x["pos"].alias("pos"), (most + x["n"]).alias("size"), ways.alias("ways"), longest.alias("chain"))))

    ends = F.aggregate("places", F.array().cast(f"array<struct<disp:bigint,pos:bigint,size:bigint,ways:bigint,chain:{chain}>>"), extend)
    ended = strands.select(*keys, "rname", "reverse", ends.alias("ends")).withColumn("size", F.array_max(F.transform("ends", lambda e: e["size"])))
    best = F.filter("ends", lambda e: e["size"] == F.col("size"))
    ended = ended.select(*keys, "size", F.aggregate(best, F.lit(0).cast("bigint"), lambda t, e: t + e["ways"]).alias("ways"), F.struct("rname", "reverse", F.get(best, 0)["chain"].alias("places")).alias("chain"))
    per = ended.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("size", "ways", "chain"))).alias("all")).withColumn("size", F.element_at("all", -1)["size"])
    top = F.filter("all", lambda s: s["size"] == F.col("size"))
    return per.select(*keys, "size", F.aggregate(top, F.lit(0).cast("bigint"), lambda t, s: t + s["ways"]).alias("ways"), F.get(top, 0)["chain"].alias("chain"))


def selected_hits(hits: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The hits of each read's largest consistent set inside a cluster; none where another set is as large."""
    keys = list(keys)
    clusters = pivot_clusters(hits, keys)
    chains = longest_chains(clusters, [*keys, "cluster"])
    per = chains.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("size", "ways", "cluster", "chain"))).alias("all")).withColumn("best", F.element_at("all", -1))
    one = F.size(F.filter("all", lambda c: c["size"] == F.col("best.size"))) == 1
    chosen = per.where(one & (F.col("best.ways") == 1)).select(*keys, F.col("best.cluster").alias("cluster"), "best.chain.rname", "best.chain.reverse", F.explode("best.chain.places").alias("p"))
    chosen = chosen.select(*keys, "cluster", "rname", "reverse", F.col("p.disp").alias("disp"), F.col("p.pos").alias("pos"))
    return clusters.join(chosen, [*keys, "cluster", "rname", "reverse", "disp", "pos"], "left_semi").select(*keys, *HIT)
