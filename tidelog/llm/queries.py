"""The corpus operators' queries over the given tables, and their SQL oracles."""

from __future__ import annotations

from .conversations import op12_conversation_repair
from .decontaminate import op4_decontaminate
from .language_id import op6_language_id
from .line_dedup import OP9_SQL, op9_line_dedup
from .mixing import op5_source_mix
from .negatives import op11_hard_negatives
from .neighbours import op13_nearest_neighbours
from .ngram_join import op3_ngram_join
from .quality_model import op7_quality_model
from .quality_rules import op1_quality_rules
from .secret_scan import op2_secret_scan
from .toxicity import op8_toxicity
from .url_filter import OP10_SQL, op10_url_filter

QUERIES = {
    "op1_quality_rules": op1_quality_rules,
    "op2_secret_scan": op2_secret_scan,
    "op3_ngram_join": op3_ngram_join,
    "op4_decontaminate": op4_decontaminate,
    "op5_source_mix": op5_source_mix,
    "op6_language_id": op6_language_id,
    "op7_quality_model": op7_quality_model,
    "op8_toxicity": op8_toxicity,
    "op9_line_dedup": op9_line_dedup,
    "op10_url_filter": op10_url_filter,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_conversation_repair": op12_conversation_repair,
    "op13_nearest_neighbours": op13_nearest_neighbours,
}
ORACLES = {
    "op9_line_dedup": OP9_SQL,
    "op10_url_filter": OP10_SQL,
}
