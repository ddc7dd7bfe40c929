"""Registered queries of this folder, and their SQL where there is one."""

from __future__ import annotations

from . import chat_windows, collocations, decontaminate, hard_negatives, lines, url_rules, warc
from .chat_windows import op4_chat_formatting
from .collocations import op12_collocations
from .decontaminate import op10_decontamination
from .hard_negatives import op13_hard_negatives
from .lines import op11_line_dedup
from .mixing import op2_source_mixing
from .neighbours import op3_embedding_dedup
from .pii import op9_personal_data
from .quality import op1_quality_classifier
from .shards import op7_sharding
from .simhash import op5_simhash_dedup
from .url_rules import op6_url_filters
from .warc import op8_warc_fixity

QUERIES = {
    query.__name__: query
    for query in (
        op1_quality_classifier,
        op2_source_mixing,
        op3_embedding_dedup,
        op4_chat_formatting,
        op5_simhash_dedup,
        op6_url_filters,
        op7_sharding,
        op8_warc_fixity,
        op9_personal_data,
        op10_decontamination,
        op11_line_dedup,
        op12_collocations,
        op13_hard_negatives,
    )
}

ORACLE = {
    "op4_chat_formatting": chat_windows.ORACLE,
    "op6_url_filters": url_rules.ORACLE,
    "op8_warc_fixity": warc.ORACLE,
    "op10_decontamination": decontaminate.ORACLE,
    "op11_line_dedup": lines.ORACLE,
    "op12_collocations": collocations.ORACLE,
    "op13_hard_negatives": hard_negatives.ORACLE,
}
