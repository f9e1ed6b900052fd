"""The queries of this subpackage and, where SQL can say the same, their SQL."""

from __future__ import annotations

from quarry.llm import sql
from quarry.llm.decontamination import op10_decontamination
from quarry.llm.html import op8_html_extraction
from quarry.llm.jaccard import op4_ngram_jaccard_join
from quarry.llm.lm import op2_lm_scoring
from quarry.llm.mixing import op7_mixing
from quarry.llm.quality import op5_quality_rules
from quarry.llm.sharding import op6_sharding
from quarry.llm.substrings import op9_substring_dedup
from quarry.llm.tokens import op1_token_files, op3_token_counts

QUERIES = {f.__name__: f for f in (op1_token_files, op2_lm_scoring, op3_token_counts, op4_ngram_jaccard_join, op5_quality_rules, op6_sharding, op7_mixing, op8_html_extraction, op9_substring_dedup, op10_decontamination)}
ORACLES = sql.ORACLES
