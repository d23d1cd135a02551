"""Queries of the training-data operators, with SQL where SQL can express them."""

from .bpe import op4
from .decontaminate import op6
from .divergence import SQL as OP12_SQL
from .divergence import op12
from .jaccard_join import op9
from .langid import op10
from .licenses import op11
from .line_dedup import SQL as OP8_SQL
from .line_dedup import op8
from .lm import op3
from .neighbours import op7
from .periodic import op13
from .quality import op1
from .substring_dedup import op2
from .suffix_dedup import op5

QUERIES = {
    "op1_quality_classifier": op1,
    "op2_substring_dedup": op2,
    "op3_lm_scoring": op3,
    "op4_byte_bpe": op4,
    "op5_suffix_dedup": op5,
    "op6_decontamination": op6,
    "op7_nearest_neighbours": op7,
    "op8_line_dedup": op8,
    "op9_jaccard_join": op9,
    "op10_language_id": op10,
    "op11_license_scan": op11,
    "op12_source_divergence": op12,
    "op13_periodic_runs": op13,
}

ORACLE_SQL: dict[str, str] = {
    "op8_line_dedup": OP8_SQL,
    "op12_source_divergence": OP12_SQL,
}
