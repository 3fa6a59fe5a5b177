"""The registered queries of this subpackage, and the SQL of those that SQL can express."""

from __future__ import annotations

from lakewarden.llm.conversation import OP11_SQL, op11_conversation_repair
from lakewarden.llm.decontaminate import op3_decontaminate
from lakewarden.llm.langid import op4_language_id
from lakewarden.llm.neardup import OP7_SQL, op7_near_duplicates
from lakewarden.llm.packing import op9_best_fit_packing
from lakewarden.llm.pii import OP5_SQL, op5_pii
from lakewarden.llm.quality import op6_quality
from lakewarden.llm.slack import op12_slack_packing
from lakewarden.llm.spelling import OP13_SQL, op13_spelling_variants
from lakewarden.llm.substring import OP10_SQL, op10_substring_dedup
from lakewarden.llm.tokenfile import op2_token_files
from lakewarden.llm.topk import OP8_SQL, op8_top_k
from lakewarden.llm.toxicity import op1_toxicity

QUERIES = {
    "op1_toxicity": op1_toxicity,
    "op2_token_files": op2_token_files,
    "op3_decontaminate": op3_decontaminate,
    "op4_language_id": op4_language_id,
    "op5_pii": op5_pii,
    "op6_quality": op6_quality,
    "op7_near_duplicates": op7_near_duplicates,
    "op8_top_k": op8_top_k,
    "op9_best_fit_packing": op9_best_fit_packing,
    "op10_substring_dedup": op10_substring_dedup,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_slack_packing": op12_slack_packing,
    "op13_spelling_variants": op13_spelling_variants,
}

ORACLE: dict[str, str] = {
    "op5_pii": OP5_SQL,
    "op7_near_duplicates": OP7_SQL,
    "op8_top_k": OP8_SQL,
    "op10_substring_dedup": OP10_SQL,
    "op11_conversation_repair": OP11_SQL,
    "op13_spelling_variants": OP13_SQL,
}
