"""The registered queries of this subpackage and the SQL they are checked against."""

from __future__ import annotations

from kinmaster.llm import (
    decontaminate,
    divergence,
    huffman,
    language,
    line_dedup,
    mixing,
    near_dup,
    neighbours,
    phrases,
    pii,
    secret_scan,
    url_rules,
    warc,
)

REGISTRY = {
    "op1_huffman": huffman.op1_huffman,
    "op2_pii": pii.op2_pii,
    "op3_url_rules": url_rules.op3_url_rules,
    "op4_language": language.op4_language,
    "op5_secrets": secret_scan.op5_secrets,
    "op6_neighbours": neighbours.op6_neighbours,
    "op7_decontaminate": decontaminate.op7_decontaminate,
    "op8_near_dup": near_dup.op8_near_dup,
    "op9_mix": mixing.op9_mix,
    "op10_line_dedup": line_dedup.op10_line_dedup,
    "op11_warc": warc.op11_warc,
    "op12_phrases": phrases.op12_phrases,
    "op13_divergence": divergence.op13_divergence,
}

ORACLE = {
    "op3_url_rules": url_rules.OP3_SQL,
    "op9_mix": mixing.OP9_SQL,
    "op11_warc": warc.OP11_SQL,
    "op12_phrases": phrases.OP12_SQL,
    "op13_divergence": divergence.OP13_SQL,
}
