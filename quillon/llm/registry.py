"""Queries of the training-data operators, and SQL for those that it can express."""

from __future__ import annotations

from .bpe import op7_bpe
from .decontaminate import OP1_SQL, op1_decontaminate
from .html_text import op4_html_text
from .language_id import op8_language_id
from .line_dedup import OP9_SQL, op9_line_dedup
from .line_quality import op6_line_quality
from .quality_cnn import op5_quality_cnn
from .simhash import op2_simhash
from .suffix_dedup import op3_suffix_dedup
from .token_counts import op10_token_counts

QUERIES = {f.__name__: f for f in (op1_decontaminate, op2_simhash, op3_suffix_dedup, op4_html_text, op5_quality_cnn, op6_line_quality, op7_bpe, op8_language_id, op9_line_dedup, op10_token_counts)}

SQL = {"op1_decontaminate": OP1_SQL, "op9_line_dedup": OP9_SQL}
