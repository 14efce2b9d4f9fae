"""Operators for training-data pipelines. Nothing else in the library imports this package."""

from salestream.llm import (
    exact_dedup,
    importance_resampling,
    jaccard_join,
    license_scan,
    line_dedup,
    mixing,
    packing,
    periodic_runs,
    simhash,
    topk_search,
    toxicity,
    url_filter,
    warc,
)

QUERIES = {
    "op1_mixing": mixing.op1_mixing,
    "op2_exact_dedup": exact_dedup.op2_exact_dedup,
    "op3_topk_search": topk_search.op3_topk_search,
    "op4_toxicity": toxicity.op4_toxicity,
    "op5_license_scan": license_scan.op5_license_scan,
    "op6_line_dedup": line_dedup.op6_line_dedup,
    "op7_simhash": simhash.op7_simhash,
    "op8_packing": packing.op8_packing,
    "op9_warc": warc.op9_warc,
    "op10_url_filter": url_filter.op10_url_filter,
    "op11_importance_resampling": importance_resampling.op11_importance_resampling,
    "op12_jaccard_join": jaccard_join.op12_jaccard_join,
    "op13_periodic_runs": periodic_runs.op13_periodic_runs,
}

ORACLE_SQL = {
    "op1_mixing": mixing.SQL,
    "op2_exact_dedup": exact_dedup.SQL,
    "op3_topk_search": topk_search.SQL,
    "op6_line_dedup": line_dedup.SQL,
    "op9_warc": warc.SQL,
    "op11_importance_resampling": importance_resampling.SQL,
    "op12_jaccard_join": jaccard_join.SQL,
}
