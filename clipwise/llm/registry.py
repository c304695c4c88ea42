"""The subpackage's queries and their SQL, for ``__spark_entry__.py``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import decontaminate, exact_dedup, fill_middle, jaccard, licenses, lm, mixing, periodic, pii, topk, toxicity, url_rules, warc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_url_filters": url_rules.op1_url_filters,
    "op2_license_scan": licenses.op2_license_scan,
    "op3_exact_topk": topk.op3_exact_topk,
    "op4_ngram_jaccard": jaccard.op4_ngram_jaccard,
    "op5_source_mix": mixing.op5_source_mix,
    "op6_toxicity": toxicity.op6_toxicity,
    "op7_pii": pii.op7_pii,
    "op8_lm_scores": lm.op8_lm_scores,
    "op9_warc": warc.op9_warc,
    "op10_decontamination": decontaminate.op10_decontamination,
    "op11_periodic_runs": periodic.op11_periodic_runs,
    "op12_fill_in_middle": fill_middle.op12_fill_in_middle,
    "op13_exact_dedup": exact_dedup.op13_exact_dedup,
}

ORACLE_SQL: dict[str, str] = {
    "op2_license_scan": licenses.OP2_SQL,
    "op3_exact_topk": topk.OP3_SQL,
    "op4_ngram_jaccard": jaccard.OP4_SQL,
    "op5_source_mix": mixing.OP5_SQL,
    "op9_warc": warc.OP9_SQL,
    "op10_decontamination": decontaminate.OP10_SQL,
    "op11_periodic_runs": periodic.OP11_SQL,
    "op12_fill_in_middle": fill_middle.OP12_SQL,
    "op13_exact_dedup": exact_dedup.OP13_SQL,
}
