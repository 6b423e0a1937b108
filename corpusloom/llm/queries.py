"""Registered queries of this package and, where SQL can express them, their SQL."""

from __future__ import annotations

from . import chat, decontaminate, repeats, trie
from .ann import op8_nearest
from .chat import op4_chat
from .decontaminate import op6_decontaminate
from .html_extract import op5_html
from .packing import op3_packing
from .pitman_yor import op9_language_model
from .quality_rank import op2_quality
from .repeats import op13_repeats
from .runs import op12_runs
from .secrets import op10_secrets
from .simhash import op1_simhash
from .toxicity import op7_toxicity
from .trie import op11_prefix_trie

QUERIES = {
    "op1_simhash": op1_simhash,
    "op2_quality": op2_quality,
    "op3_packing": op3_packing,
    "op4_chat": op4_chat,
    "op5_html": op5_html,
    "op6_decontaminate": op6_decontaminate,
    "op7_toxicity": op7_toxicity,
    "op8_nearest": op8_nearest,
    "op9_language_model": op9_language_model,
    "op10_secrets": op10_secrets,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_runs": op12_runs,
    "op13_repeats": op13_repeats,
}

# The others are not expressible in SQL at whole-table cost; tests/llm holds them to brute force.
ORACLE: dict[str, str] = {
    "op4_chat": chat.SQL,
    "op6_decontaminate": decontaminate.SQL,
    "op11_prefix_trie": trie.SQL,
    "op13_repeats": repeats.SQL,
}
