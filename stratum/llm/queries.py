"""The registered queries of the training-data operators, and their SQL."""

from __future__ import annotations

from stratum.llm.chat import op9_chat_windows
from stratum.llm.decontaminate import op5_decontaminate
from stratum.llm.lines import op8_fuzzy_lines
from stratum.llm.mixing import op7_mixing_rates
from stratum.llm.neardup import op2_near_duplicates
from stratum.llm.oracle import ORACLE
from stratum.llm.pii import op6_pii_spans
from stratum.llm.quality import op10_quality_rules
from stratum.llm.search import op11_ranked_search
from stratum.llm.secrets import op13_secret_scan
from stratum.llm.sharding import op1_shard_balance
from stratum.llm.tokens import op4_token_counts
from stratum.llm.toxicity import op3_toxicity
from stratum.llm.trie import op12_prefix_trie

QUERIES = {
    "op1_shard_balance": op1_shard_balance,
    "op2_near_duplicates": op2_near_duplicates,
    "op3_toxicity": op3_toxicity,
    "op4_token_counts": op4_token_counts,
    "op5_decontaminate": op5_decontaminate,
    "op6_pii_spans": op6_pii_spans,
    "op7_mixing_rates": op7_mixing_rates,
    "op8_fuzzy_lines": op8_fuzzy_lines,
    "op9_chat_windows": op9_chat_windows,
    "op10_quality_rules": op10_quality_rules,
    "op11_ranked_search": op11_ranked_search,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_secret_scan": op13_secret_scan,
}

__all__ = ["ORACLE", "QUERIES"]
