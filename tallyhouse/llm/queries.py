"""The queries of this subpackage and their checks in DuckDB's SQL."""

from __future__ import annotations

from tallyhouse.llm.compression_quality import op5_compression_quality
from tallyhouse.llm.decontaminate import OP9_SQL, op9_decontamination
from tallyhouse.llm.filter_audit import OP13_SQL, op13_filter_audit
from tallyhouse.llm.html_extract import op4_html_extraction
from tallyhouse.llm.jaccard_join import OP3_LINKS_SQL, OP3_SQL, op3_jaccard_join, op3_jaccard_links
from tallyhouse.llm.language import op10_language_id
from tallyhouse.llm.lm_scoring import OP6_SQL, op6_lm_scoring
from tallyhouse.llm.mixing import OP8_SQL, op8_mixing
from tallyhouse.llm.prefix_trie import OP11_SQL, op11_prefix_trie
from tallyhouse.llm.quality_rules import OP1_SQL, op1_quality_rules
from tallyhouse.llm.sharding import op2_sharding
from tallyhouse.llm.substrings import OP7_SQL, op7_substring_dedup
from tallyhouse.llm.toxicity import op12_toxicity

QUERIES = {
    "op1_quality_rules": op1_quality_rules,
    "op2_sharding": op2_sharding,
    "op3_jaccard_join": op3_jaccard_join,
    "op3_jaccard_links": op3_jaccard_links,
    "op4_html_extraction": op4_html_extraction,
    "op5_compression_quality": op5_compression_quality,
    "op6_lm_scoring": op6_lm_scoring,
    "op7_substring_dedup": op7_substring_dedup,
    "op8_mixing": op8_mixing,
    "op9_decontamination": op9_decontamination,
    "op10_language_id": op10_language_id,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_toxicity": op12_toxicity,
    "op13_filter_audit": op13_filter_audit,
}

ORACLES = {
    "op1_quality_rules": OP1_SQL,
    "op3_jaccard_join": OP3_SQL,
    "op3_jaccard_links": OP3_LINKS_SQL,
    "op6_lm_scoring": OP6_SQL,
    "op7_substring_dedup": OP7_SQL,
    "op8_mixing": OP8_SQL,
    "op9_decontamination": OP9_SQL,
    "op11_prefix_trie": OP11_SQL,
    "op13_filter_audit": OP13_SQL,
}
