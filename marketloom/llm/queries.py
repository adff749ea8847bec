"""Registered queries of this subpackage and their DuckDB statements."""

from __future__ import annotations

from marketloom.llm.dialogue import op12_banded_grammar_repair
from marketloom.llm.fingerprint import op10_iblt_fingerprints
from marketloom.llm.language import op8_kneser_ney_language
from marketloom.llm.lm import op7_count_filter_scores
from marketloom.llm.mixing import op1_golden_ratio_mix
from marketloom.llm.neardup import op3_odd_sketches
from marketloom.llm.negatives import op11_slot_negatives
from marketloom.llm.packing import op4_minimum_bin_slack
from marketloom.llm.passages import op13_rabin_karp_windows
from marketloom.llm.pii import op9_surrogates
from marketloom.llm.quality import op2_quality_rules, op2_sql
from marketloom.llm.sharding import op6_hypergeometric_shards
from marketloom.llm.substring import op5_radix_sorted_suffixes

QUERIES = {
    f.__name__: f
    for f in (
        op1_golden_ratio_mix,
        op2_quality_rules,
        op3_odd_sketches,
        op4_minimum_bin_slack,
        op5_radix_sorted_suffixes,
        op6_hypergeometric_shards,
        op7_count_filter_scores,
        op8_kneser_ney_language,
        op9_surrogates,
        op10_iblt_fingerprints,
        op11_slot_negatives,
        op12_banded_grammar_repair,
        op13_rabin_karp_windows,
    )
}

# The others draw, hash, learn or iterate in ways that SQL cannot express; tests hold
# them against brute force.
ORACLES = {"op2_quality_rules": op2_sql()}
