"""The registered queries of this package and their SQL."""

from __future__ import annotations

from . import op2_warc as warc_query
from . import op4_url_reputation as url_query
from . import op11_vector_codes as codes_query
from . import op13_fill_in_middle as middle_query
from .op1_sentencepiece import op1_sentencepiece
from .op2_warc import op2_warc
from .op3_toxicity import op3_toxicity
from .op4_url_reputation import op4_url_reputation
from .op5_pii import op5_pii
from .op6_quality import op6_quality
from .op7_language_model import op7_language_model
from .op8_quality_rules import op8_quality_rules
from .op9_decontaminate import op9_decontaminate
from .op10_near_dup import op10_near_dup
from .op11_vector_codes import op11_vector_codes
from .op12_token_counts import op12_token_counts
from .op13_fill_in_middle import op13_fill_in_middle

QUERIES = {f.__name__: f for f in (
    op1_sentencepiece, op2_warc, op3_toxicity, op4_url_reputation, op5_pii, op6_quality,
    op7_language_model, op8_quality_rules, op9_decontaminate, op10_near_dup,
    op11_vector_codes, op12_token_counts, op13_fill_in_middle)}
#: The other queries are checked in tests/llm by brute force, round trips or held-out accuracy.
ORACLE: dict[str, str] = {
    "op2_warc": warc_query.ORACLE, "op4_url_reputation": url_query.ORACLE, "op11_vector_codes": codes_query.ORACLE,
    "op13_fill_in_middle": middle_query.ORACLE}
