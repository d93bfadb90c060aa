"""The registered queries of the corpus operators, and their SQL where SQL can express them."""

from __future__ import annotations

from cellweave.llm.ann import op1_nearest
from cellweave.llm.chat import op12_chat_formatting, op12_sql
from cellweave.llm.decontaminate import op8_decontamination
from cellweave.llm.kmeans import op11_kmeans, op11_sql
from cellweave.llm.lexical import op13_lexical_search, op13_sql
from cellweave.llm.line_dedup import op6_line_dedup
from cellweave.llm.licenses import op2_licenses, op2_sql
from cellweave.llm.packing import op5_packing
from cellweave.llm.secrets import op7_secrets
from cellweave.llm.simhash import op3_simhash
from cellweave.llm.substring_dedup import op9_substring_dedup
from cellweave.llm.token_counts import op10_token_counts
from cellweave.llm.toxicity import op4_toxicity


def queries() -> dict:
    return {
        "op1_nearest": op1_nearest,
        "op2_licenses": op2_licenses,
        "op3_simhash": op3_simhash,
        "op4_toxicity": op4_toxicity,
        "op5_packing": op5_packing,
        "op6_line_dedup": op6_line_dedup,
        "op7_secrets": op7_secrets,
        "op8_decontamination": op8_decontamination,
        "op9_substring_dedup": op9_substring_dedup,
        "op10_token_counts": op10_token_counts,
        "op11_kmeans": op11_kmeans,
        "op12_chat_formatting": op12_chat_formatting,
        "op13_lexical_search": op13_lexical_search,
    }


def oracle_sql() -> dict[str, str]:
    return {"op2_licenses": op2_sql(), "op11_kmeans": op11_sql(), "op12_chat_formatting": op12_sql(), "op13_lexical_search": op13_sql()}
