"""Registered queries of the training-data operators, and the SQL of those that SQL can express."""

from __future__ import annotations

from strandlake.llm.decontaminate import op5_decontaminate
from strandlake.llm.fingerprint import op4_fingerprints
from strandlake.llm.langid import op3_langid
from strandlake.llm.licenses import op8_licenses
from strandlake.llm.ngram_join import op2_ngram_join
from strandlake.llm.packing import op9_packing
from strandlake.llm.secret_scan import op6_secrets
from strandlake.llm.toxicity import op7_toxicity
from strandlake.llm.url_rules import OP10_SQL, op10_url_filters
from strandlake.llm.warc import OP1_SQL, op1_warc
from strandlake.session import smaller_batches


def _set_up(query):
    """The query as an application that bounds the bytes a Python worker gets at once."""
    def run(spark, sf_dir):
        smaller_batches(spark)
        return query(spark, sf_dir)

    return run


_QUERIES = {
    "op1_warc": op1_warc,
    "op2_ngram_join": op2_ngram_join,
    "op3_langid": op3_langid,
    "op4_fingerprints": op4_fingerprints,
    "op5_decontaminate": op5_decontaminate,
    "op6_secrets": op6_secrets,
    "op7_toxicity": op7_toxicity,
    "op8_licenses": op8_licenses,
    "op9_packing": op9_packing,
    "op10_url_filters": op10_url_filters,
}
QUERIES = {name: _set_up(query) for name, query in _QUERIES.items()}
ORACLE_SQL = {"op1_warc": OP1_SQL, "op10_url_filters": OP10_SQL}
