"""Registered queries of the training-data operators, and their DuckDB SQL."""

from __future__ import annotations

from stratum.llm.alignment import alignment_query
from stratum.llm.decontamination import decontamination_query
from stratum.llm.extraction import extraction_query
from stratum.llm.fingerprints import fingerprints_query
from stratum.llm.minhash import minhash_query, minhash_sql
from stratum.llm.overlap_join import overlap_join_query, overlap_join_sql
from stratum.llm.packing import packing_query
from stratum.llm.quality import quality_query
from stratum.llm.sharding import sharding_query, sharding_sql
from stratum.llm.spelling import spelling_query, spelling_sql
from stratum.llm.toxicity import toxicity_query
from stratum.llm.url_filter import url_filter_query
from stratum.llm.warc import warc_query, warc_sql

QUERIES = {
    "op1_extraction": extraction_query,
    "op2_minhash": minhash_query,
    "op3_toxicity": toxicity_query,
    "op4_warc": warc_query,
    "op5_url_filter": url_filter_query,
    "op6_fingerprints": fingerprints_query,
    "op7_packing": packing_query,
    "op8_quality": quality_query,
    "op9_sharding": sharding_query,
    "op10_decontamination": decontamination_query,
    "op11_spelling": spelling_query,
    "op12_overlap_join": overlap_join_query,
    "op13_alignment": alignment_query,
}


def oracle_sql() -> dict[str, str]:
    return {
        "op2_minhash": minhash_sql(),
        "op4_warc": warc_sql(),
        "op9_sharding": sharding_sql(),
        "op11_spelling": spelling_sql(),
        "op12_overlap_join": overlap_join_sql(),
    }
