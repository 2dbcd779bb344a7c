"""The registered queries of this folder and the SQL of those that SQL can express."""

from __future__ import annotations

import os
from collections.abc import Callable
from functools import wraps
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from corpus_pipeline import run as pipeline
from rawstrata.llm.op1_mixing import op1_mixing
from rawstrata.llm.op2_substring_dedup import op2_substring_dedup
from rawstrata.llm.op3_exact_top_k import SQL as TOP_K_SQL, op3_exact_top_k
from rawstrata.llm.op4_near_dedup import SQL as NEAR_DEDUP_SQL, op4_near_dedup
from rawstrata.llm.op5_toxicity import op5_toxicity
from rawstrata.llm.op6_quality_classifier import op6_quality_classifier
from rawstrata.llm.op7_sentencepiece import op7_sentencepiece
from rawstrata.llm.op8_quality_rules import SQL as QUALITY_RULES_SQL, op8_quality_rules
from rawstrata.llm.op9_secret_scan import op9_secret_scan
from rawstrata.llm.op10_url_filters import SQL as URL_FILTERS_SQL, op10_url_filters
from rawstrata.llm.op11_importance_resampling import SQL as RESAMPLING_SQL, op11_importance_resampling
from rawstrata.llm.op12_collocations import SQL as COLLOCATIONS_SQL, op12_collocations
from rawstrata.llm.op13_html_extraction import op13_html_extraction

Query = Callable[[SparkSession, str], DataFrame]
ROOT = str(Path(__file__).resolve().parents[2])


def importable(query: Query) -> Query:
    """Let Python workers find this package where the session's own path does not name it."""

    @wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        held = spark.sparkContext.environment
        paths = held.get("PYTHONPATH", "").split(os.pathsep)
        if ROOT not in paths:
            held["PYTHONPATH"] = os.pathsep.join([ROOT, *filter(None, paths)])
        return query(spark, sf_dir)

    return run


QUERIES = {
    "op1_mixing": op1_mixing,
    "op2_substring_dedup": op2_substring_dedup,
    "op3_exact_top_k": op3_exact_top_k,
    "op4_near_dedup": op4_near_dedup,
    "op5_toxicity": op5_toxicity,
    "op6_quality_classifier": op6_quality_classifier,
    "op7_sentencepiece": op7_sentencepiece,
    "op8_quality_rules": op8_quality_rules,
    "op9_secret_scan": op9_secret_scan,
    "op10_url_filters": op10_url_filters,
    "op11_importance_resampling": op11_importance_resampling,
    "op12_collocations": op12_collocations,
    "op13_html_extraction": op13_html_extraction,
    "pipeline": pipeline,
}
QUERIES = {name: importable(query) for name, query in QUERIES.items()}

SQL = {
    "op3_exact_top_k": TOP_K_SQL,
    "op4_near_dedup": NEAR_DEDUP_SQL,
    "op8_quality_rules": QUALITY_RULES_SQL,
    "op10_url_filters": URL_FILTERS_SQL,
    "op11_importance_resampling": RESAMPLING_SQL,
    "op12_collocations": COLLOCATIONS_SQL,
}
