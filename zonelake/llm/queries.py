"""Query keys of the training-data operators, and the DuckDB SQL of those that SQL can express."""

from __future__ import annotations

from zonelake.llm.decontam import op5_decontamination
from zonelake.llm.divergence import OP11_SQL, op11_source_divergence
from zonelake.llm.exact_dedup import OP2_SQL, op2_exact_dedup
from zonelake.llm.group_join import OP13_SQL, op13_jaccard_join
from zonelake.llm.langid import op6_language_id
from zonelake.llm.line_dedup import OP7_SQL, op7_line_dedup
from zonelake.llm.packing import op9_packing
from zonelake.llm.prefix_trie import OP12_SQL, op12_prefix_trie
from zonelake.llm.quotes import OP10_SQL, op10_chat_formatting
from zonelake.llm.secrets import op3_secret_scan
from zonelake.llm.simhash import op1_simhash_near_dedup
from zonelake.llm.suffix_dedup import op8_suffix_dedup
from zonelake.llm.token_counts import op4_token_counts

QUERIES = {
    "op1_simhash_near_dedup": op1_simhash_near_dedup,
    "op2_exact_dedup": op2_exact_dedup,
    "op3_secret_scan": op3_secret_scan,
    "op4_token_counts": op4_token_counts,
    "op5_decontamination": op5_decontamination,
    "op6_language_id": op6_language_id,
    "op7_line_dedup": op7_line_dedup,
    "op8_suffix_dedup": op8_suffix_dedup,
    "op9_packing": op9_packing,
    "op10_chat_formatting": op10_chat_formatting,
    "op11_source_divergence": op11_source_divergence,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_jaccard_join": op13_jaccard_join,
}

ORACLE_SQL = {
    "op2_exact_dedup": OP2_SQL,
    "op7_line_dedup": OP7_SQL,
    "op10_chat_formatting": OP10_SQL,
    "op11_source_divergence": OP11_SQL,
    "op12_prefix_trie": OP12_SQL,
    "op13_jaccard_join": OP13_SQL,
}
