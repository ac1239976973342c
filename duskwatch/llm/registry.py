"""The registered queries of this subpackage and their SQL restatements."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from duskwatch.llm.chat import op9_chat_formatting
from duskwatch.llm.fingerprint import op8_document_fingerprints
from duskwatch.llm.licences import OP1_SQL, op1_license_scan
from duskwatch.llm.linededup import OP4_SQL, op4_line_dedup
from duskwatch.llm.merkle import OP12_SQL, op12_merkle_manifest
from duskwatch.llm.minhash import op7_minhash_near_dedup
from duskwatch.llm.mixing import OP3_SQL, op3_poisson_mixing
from duskwatch.llm.neighbours import op10_nearest_neighbours
from duskwatch.llm.packing import op6_best_fit_packing
from duskwatch.llm.quality import op13_quality_classifier
from duskwatch.llm.repair import OP11_SQL, op11_conversation_repair
from duskwatch.llm.tokens import op2_token_files
from duskwatch.llm.toxicity import op5_toxicity

LLM_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    q.__name__: q
    for q in (
        op1_license_scan,
        op2_token_files,
        op3_poisson_mixing,
        op4_line_dedup,
        op5_toxicity,
        op6_best_fit_packing,
        op7_minhash_near_dedup,
        op8_document_fingerprints,
        op9_chat_formatting,
        op10_nearest_neighbours,
        op11_conversation_repair,
        op12_merkle_manifest,
        op13_quality_classifier,
    )
}

# Queries that SQL can express.
LLM_ORACLES: dict[str, str] = {
    "op1_license_scan": OP1_SQL,
    "op3_poisson_mixing": OP3_SQL,
    "op4_line_dedup": OP4_SQL,
    "op11_conversation_repair": OP11_SQL,
    "op12_merkle_manifest": OP12_SQL,
}
