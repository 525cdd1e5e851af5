"""Registered queries of the subpackage and their SQL."""

from __future__ import annotations

from .cap_filters import OP1_SQL, op1_cap_filters
from .chat_assembly import OP8_SQL, op8_chat_format
from .decontamination import OP9_SQL, op9_decontaminate
from .html_extraction import op7_html_extraction
from .language_id import op4_language_id
from .license_scan import OP10_SQL, op10_license_scan
from .line_dedup import op3_line_dedup
from .merkle_manifest import OP13_SQL, op13_merkle_manifest
from .ngram_join import OP2_SQL, op2_ngram_join
from .pattern_packing import op6_pattern_packing
from .sharding import op11_sharding
from .token_alignment import op12_token_alignment
from .url_filter import op5_url_filter

QUERIES = {
    "op3_line_dedup": op3_line_dedup,
    "op1_cap_filters": op1_cap_filters,
    "op2_ngram_join": op2_ngram_join,
    "op4_language_id": op4_language_id,
    "op5_url_filter": op5_url_filter,
    "op6_pattern_packing": op6_pattern_packing,
    "op7_html_extraction": op7_html_extraction,
    "op8_chat_format": op8_chat_format,
    "op9_decontaminate": op9_decontaminate,
    "op10_license_scan": op10_license_scan,
    "op11_sharding": op11_sharding,
    "op12_token_alignment": op12_token_alignment,
    "op13_merkle_manifest": op13_merkle_manifest,
}

ORACLE_SQL = {
    "op1_cap_filters": OP1_SQL,
    "op2_ngram_join": OP2_SQL,
    "op8_chat_format": OP8_SQL,
    "op9_decontaminate": OP9_SQL,
    "op10_license_scan": OP10_SQL,
    "op13_merkle_manifest": OP13_SQL,
}


def queries():
    return dict(QUERIES)


def oracle_sql():
    return dict(ORACLE_SQL)
