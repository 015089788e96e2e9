"""Small rules of job descriptions: partition specs, task counts, aligner arguments, manifest addresses."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def key_columns(spec: str, columns: list[str]) -> list[Column]:
    """Sort or partition columns of a spec like ``-k1,2 -k3,3nr``: one-based fields, ``n`` for numbers, ``r`` for descending.

    A field without an end reaches to the last column.
    """
    out = []
    for part in re.findall(r"-k\s*(\S+)", spec):
        m = re.fullmatch(r"(\d+)([nr]*)(?:,(\d+)([nr]*))?", part)
        if not m or int(m[1]) < 1:
            raise ValueError(f"not a key: {part}")
        first, last = int(m[1]), int(m[3]) if m[3] else len(columns)
        if not first <= last <= len(columns):
            raise ValueError(f"fields out of range: {part}")
        flags = (m[2] or "") + (m[4] or "")
        for name in columns[first - 1 : last]:
            c = F.col(name).try_cast("double") if "n" in flags else F.col(name)
            out.append(c.desc() if "r" in flags else c.asc())
    return out


def task_count(rule: str, slots: int) -> int:
    """``12`` is 12 tasks, ``3x`` three for each slot, ``5,40`` the next multiple of the slots from 5, 40 at most."""
    if rule.endswith("x"):
        return max(1, int(rule[:-1]) * slots)
    low, comma, high = rule.partition(",")
    if not comma:
        return max(1, int(low))
    wanted = -(-int(low or 1) // slots) * slots
    return min(wanted, int(high)) if high else wanted


def reported_alignments(arguments: str) -> int:
    """How many alignments ``-k`` or ``-a`` ask for, the later one winning; -1 is all, 1 the default."""
    found = re.findall(r"(?:^|\s)(?:(-a|--all)|-k\s*(\d+))(?=\s|$)", arguments)
    return (-1 if found[-1][0] else int(found[-1][1])) if found else 1


def localized(manifest: DataFrame, folder: str) -> DataFrame:
    """A manifest whose addresses point to files of the same names in ``folder``."""
    moved = lambda c: F.when(F.col(c).isNotNull(), F.regexp_replace(c, r"^.*/", folder.rstrip("/") + "/")).alias(c)
    return manifest.select(*(moved(c) if c in ("url1", "url2") else c for c in manifest.columns))


def one_row_tasks(df: DataFrame, most: int = 10_000) -> DataFrame:
    """Each row as a task of its own, up to ``most`` tasks."""
    n = min(most, max(1, df.count()))
    return df.repartition(n)
