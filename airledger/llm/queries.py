"""The registered queries of this package and, where SQL can express one, its counterpart."""

from __future__ import annotations

from airledger.llm.op1_toxicity import op1_toxicity
from airledger.llm.op2_url_filters import op2_url_filters
from airledger.llm.op3_minhash_dedup import op3_minhash_dedup
from airledger.llm.op4_suffix_dedup import op4_suffix_dedup
from airledger.llm.op5_secrets import op5_secrets
from airledger.llm.op6_substring_dedup import op6_substring_dedup
from airledger.llm.op7_bpe import op7_bpe
from airledger.llm.op8_quality import op8_quality
from airledger.llm.op10_decontamination import op10_decontamination
from airledger.llm.op11_simhash_dedup import op11_simhash_dedup
from airledger.llm.op12_prefix_trie import ORACLE_SQL as PREFIX_TRIE_SQL
from airledger.llm.op12_prefix_trie import op12_prefix_trie
from airledger.llm.op13_centroid_clustering import ORACLE_SQL as CENTROIDS_SQL
from airledger.llm.op13_centroid_clustering import op13_centroid_clustering
from airledger.llm.op9_quality_rules import ORACLE_SQL as QUALITY_RULES_SQL
from airledger.llm.op9_quality_rules import op9_quality_rules

QUERIES = {
    "op1_toxicity": op1_toxicity,
    "op2_url_filters": op2_url_filters,
    "op3_minhash_dedup": op3_minhash_dedup,
    "op4_suffix_dedup": op4_suffix_dedup,
    "op5_secrets": op5_secrets,
    "op6_substring_dedup": op6_substring_dedup,
    "op7_bpe": op7_bpe,
    "op8_quality": op8_quality,
    "op9_quality_rules": op9_quality_rules,
    "op10_decontamination": op10_decontamination,
    "op11_simhash_dedup": op11_simhash_dedup,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_centroid_clustering": op13_centroid_clustering,
}
ORACLES = {
    "op9_quality_rules": QUALITY_RULES_SQL,
    "op12_prefix_trie": PREFIX_TRIE_SQL,
    "op13_centroid_clustering": CENTROIDS_SQL,
}
