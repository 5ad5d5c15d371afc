"""Queries of the operators and their DuckDB twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from trackwise.llm.decontaminate import OP3_SQL, op3_decontamination
from trackwise.llm.embeddings import OP10_SQL, op10_embedding_dedup
from trackwise.llm.html_text import op6_html_extraction
from trackwise.llm.lexical_search import OP12_SQL, op12_ranked_search
from trackwise.llm.licenses import op8_license_scan
from trackwise.llm.packing import op9_packing
from trackwise.llm.periodic_runs import op13_periodic_runs
from trackwise.llm.pii import op7_pii_surrogates
from trackwise.llm.secrets import OP11_SQL, op11_secret_scan
from trackwise.llm.simhash import op1_simhash
from trackwise.llm.substring_dedup import OP2_SQL, op2_substring_dedup
from trackwise.llm.toxicity import op5_toxicity
from trackwise.llm.url_filter import OP4_SQL, op4_url_filter

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_simhash": op1_simhash,
    "op2_substring_dedup": op2_substring_dedup,
    "op3_decontamination": op3_decontamination,
    "op4_url_filter": op4_url_filter,
    "op5_toxicity": op5_toxicity,
    "op6_html_extraction": op6_html_extraction,
    "op7_pii_surrogates": op7_pii_surrogates,
    "op8_license_scan": op8_license_scan,
    "op9_packing": op9_packing,
    "op10_embedding_dedup": op10_embedding_dedup,
    "op11_secret_scan": op11_secret_scan,
    "op12_ranked_search": op12_ranked_search,
    "op13_periodic_runs": op13_periodic_runs,
}

ORACLE: dict[str, str] = {
    "op2_substring_dedup": OP2_SQL,
    "op3_decontamination": OP3_SQL,
    "op4_url_filter": OP4_SQL,
    "op10_embedding_dedup": OP10_SQL,
    "op11_secret_scan": OP11_SQL,
    "op12_ranked_search": OP12_SQL,
}
