"""All registered queries on the reference relations."""

from strandlake.plans import (  # noqa: F401
    queries_alignments,
    queries_coverage,
    queries_dataflow,
    queries_junctions,
    queries_metrics,
    queries_sequences,
)
from strandlake.plans.registry import ORACLE_SQL, QUERIES  # noqa: F401
