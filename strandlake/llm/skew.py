"""Statistics of groups of which a few may hold very many rows.

A window over a key makes each key one task's work. Here the statistics are aggregated, which
the tasks do in part before any shuffle, written, and joined back: a join with one row per key on
one side is split by adaptive execution where the other side has very many rows of a key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandlake.llm.common import materialize


def grouped(rows: DataFrame, key: str, where: Column | str | None = None, **stats: Column) -> DataFrame:
    """``rows`` with aggregates over the rows of equal ``key``; only groups for which ``where`` holds of these.

    ``rows`` should be written already, as it is read twice. A null key's rows are left out.
    """
    groups = rows.groupBy(key).agg(*(s.alias(n) for n, s in stats.items()))
    if where is not None:
        groups = groups.where(where)
    groups = materialize(groups, "groups")  # an exchange on both sides, which can be split
    return rows.join(groups, key).select(*rows.columns, *stats)
