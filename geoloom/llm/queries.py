"""The corpus queries, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from geoloom.llm.decontam import OP6_SQL, op6_decontamination
from geoloom.llm.language import op9_language_id
from geoloom.llm.mixing import op4_source_mixture
from geoloom.llm.neardup import op8_near_duplicates
from geoloom.llm.neighbours import op7_nearest_neighbours
from geoloom.llm.pages import op10_main_text
from geoloom.llm.pii import op1_pii_pseudonyms
from geoloom.llm.secrets import op5_secrets
from geoloom.llm.tokens import op2_token_counts
from geoloom.llm.toxicity import op3_toxicity

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_pii_pseudonyms": op1_pii_pseudonyms,
    "op2_token_counts": op2_token_counts,
    "op3_toxicity": op3_toxicity,
    "op4_source_mixture": op4_source_mixture,
    "op5_secrets": op5_secrets,
    "op6_decontamination": op6_decontamination,
    "op7_nearest_neighbours": op7_nearest_neighbours,
    "op8_near_duplicates": op8_near_duplicates,
    "op9_language_id": op9_language_id,
    "op10_main_text": op10_main_text,
}

SQL: dict[str, str] = {
    "op6_decontamination": OP6_SQL,
}
