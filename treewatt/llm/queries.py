"""Registered queries of the text operators, and SQL where SQL can express them."""

from __future__ import annotations

from treewatt.llm import (
    bpe,
    decontaminate,
    hard_negatives,
    mixing,
    periodic_runs,
    pii,
    quartile_digest,
    simhash,
    token_counts,
    token_shards,
    toxicity,
    url_rules,
    warc,
)

QUERIES = {
    query.__name__: query
    for query in (
        warc.op1_warc,
        url_rules.op2_url_rules,
        token_counts.op3_token_counts,
        pii.op4_pii,
        mixing.op5_mix_sources,
        simhash.op6_simhash,
        toxicity.op7_toxicity,
        quartile_digest.op8_quartile_digest,
        decontaminate.op9_decontaminate,
        token_shards.op10_token_shards,
        hard_negatives.op11_hard_negatives,
        periodic_runs.op12_periodic_runs,
        bpe.op13_bpe,
    )
}

ORACLE_SQL = {
    **warc.ORACLE_SQL,
    **url_rules.ORACLE_SQL,
    **mixing.ORACLE_SQL,
    **decontaminate.ORACLE_SQL,
    **hard_negatives.ORACLE_SQL,
}
