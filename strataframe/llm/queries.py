"""Queries opN_<name> of this subpackage, each over its whole table, and the SQL of those that SQL can express."""

from strataframe.llm import bpe, chat, decontaminate, html, langid, lm, quality, shards, simhash, toxicity

QUERIES = {
    f.__name__: f
    for f in (
        simhash.op1_simhash_near_dedup,
        shards.op2_kd_shards,
        shards.op2_kd_shards_fine,
        toxicity.op3_toxicity,
        lm.op4_lm_pseudo_likelihood,
        chat.op5_chat_format,
        quality.op6_quality_rules,
        decontaminate.op7_benchmark_decontamination,
        html.op8_html_content,
        langid.op9_language_mixture,
        bpe.op10_byte_bpe,
    )
}

#: None for 3, 4, 8, 9 and 10: networks, a parser, per-document iteration and merges by rank.
SQL = {
    "op1_simhash_near_dedup": simhash.SQL,
    "op2_kd_shards": shards.SQL,
    "op2_kd_shards_fine": shards.FINE_SQL,
    "op5_chat_format": chat.SQL,
    "op6_quality_rules": quality.SQL,
    "op7_benchmark_decontamination": decontaminate.SQL,
}
