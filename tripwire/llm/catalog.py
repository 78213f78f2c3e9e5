"""Queries of this subpackage, and their DuckDB SQL where SQL can express them."""

from __future__ import annotations

from tripwire.llm import (alignment, decontaminate, html_text, langid, lexical, line_quality, mixing, neighbours, passages,
                          secrets, simhash, url_filter, warc)

QUERIES = {
    "op1_neighbours": neighbours.query,
    "op2_decontaminate": decontaminate.query,
    "op3_simhash": simhash.query,
    "op4_langid": langid.query,
    "op5_mixing": mixing.query,
    "op6_passages": passages.query,
    "op7_secrets": secrets.query,
    "op8_warc": warc.query,
    "op9_html_text": html_text.query,
    "op10_url_filter": url_filter.query,
    "op11_line_quality": line_quality.query,
    "op12_lexical": lexical.query,
    "op13_alignment": alignment.query,
}

ORACLE: dict[str, str] = {
    "op2_decontaminate": decontaminate.ORACLE,
    "op5_mixing": mixing.ORACLE,
    "op7_secrets": secrets.ORACLE,
    "op8_warc": warc.ORACLE,
    "op11_line_quality": line_quality.ORACLE,
    "op12_lexical": lexical.ORACLE,
}
