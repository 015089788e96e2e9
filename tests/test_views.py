"""The intron queries read all of their tables."""

import os

import pytest

from strandlake.plans.queries import QUERIES
from strandlake.plans.views import table, view

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables are not here")


def test_introns_of_every_line(spark):
    lines = table(spark, SF, "lineitem").select("l_returnflag", "l_partkey", "l_suppkey").collect()
    want = {(f, s % 5, p * 40, p * 40 + 20 + s % 50) for f, p, s in lines}
    got = [tuple(r) for r in view(spark, SF, "v_introns").select("rname", "sample", "start", "end_pos").collect()]
    assert len(got) == len(want) and set(got) == want


def test_every_contig_has_fragments(spark):
    flags = {r[0] for r in table(spark, SF, "lineitem").select("l_returnflag").distinct().collect()}
    assert {r[0] for r in view(spark, SF, "v_reference").select("rname").distinct().collect()} == flags
    assert {r[0] for r in QUERIES["fragment_sequences"](spark, SF).select("rname").distinct().collect()} == flags
