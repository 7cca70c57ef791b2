"""The registered queries of the corpus operators and their DuckDB statements."""

from __future__ import annotations

from airshed.llm import chat, decontamination, infill, jaccard, merkle, minhash, packing, phrases, quality, secret_scan, sharding, tokens, warc

QUERIES = {
    "op1_sampled_splitters": sharding.op1_sampled_splitters,
    "op2_dictionary_warc": warc.op2_dictionary_warc,
    "op3_power_of_two": packing.op3_power_of_two,
    "op4_fm_index": decontamination.op4_fm_index,
    "op5_phrase_automata": phrases.op5_phrase_automata,
    "op6_snapshot_collapse": chat.op6_snapshot_collapse,
    "op7_digest_cache": tokens.op7_digest_cache,
    "op8_parity_sketch": jaccard.op8_parity_sketch,
    "op9_rule_ledger": quality.op9_rule_ledger,
    "op10_randomness_battery": secret_scan.op10_randomness_battery,
    "op11_indexable_skip_list": infill.op11_indexable_skip_list,
    "op12_time_forward": merkle.op12_time_forward,
    "op13_hyper_minhash": minhash.op13_hyper_minhash,
}

ORACLES = {
    "op2_dictionary_warc": warc.ORACLE,
    "op4_fm_index": decontamination.ORACLE,
    "op5_phrase_automata": phrases.ORACLE,
    "op6_snapshot_collapse": chat.ORACLE,
    "op8_parity_sketch": jaccard.ORACLE,
    "op9_rule_ledger": quality.ORACLE,
    "op11_indexable_skip_list": infill.ORACLE,
    "op12_time_forward": merkle.ORACLE,
    "op13_hyper_minhash": minhash.ORACLE,
}
