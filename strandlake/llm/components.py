"""Connected components of a link table, by alternating large-star and small-star steps.

Every step is a grouped minimum, which is pre-aggregated in the tasks, and a join that can be
split where one node has very many links. Each step's links are written to the shared
scratch folder; nothing but their count and a checksum reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandlake.llm.common import drop_scratch, materialize


def _large_star(links: DataFrame) -> DataFrame:
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(links: DataFrame) -> DataFrame:
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    joined = down.join(least, "a")
    return joined.select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", F.col("m").alias("b")))


def _state(links: DataFrame) -> tuple:
    row = links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return row[0], row[1]


def components(links: DataFrame, max_rounds: int = 100) -> DataFrame:
    """``node, label`` for every node of ``links`` (``a``, ``b`` long) that isn't the least of its component.

    ``label`` is the least node of the component. Repeated links, links in both directions and
    links of a node with itself are allowed; an empty table gives none.
    """
    now = materialize(links.select("a", "b").where("a <> b").distinct(), "links")
    state = _state(now)
    for _ in range(max_rounds):
        if state[0] == 0:
            break
        new = materialize(_small_star(_large_star(now).where("a <> b").distinct()).where("a <> b").distinct(), "links")
        new_state = _state(new)
        drop_scratch(now)
        now = new
        if new_state == state:
            break
        state = new_state
    else:
        raise RuntimeError("components didn't settle")
    return now.select(F.col("a").alias("node"), F.col("b").alias("label"))
