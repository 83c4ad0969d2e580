"""The queries of this subpackage by name, and the SQL of those that SQL can express."""

from __future__ import annotations

from lamina.llm import bpe, decontam, minhash, passages, phrases, pii, secret_scan, simhash, simhash_dedup, token_rollup, toxicity, turn_repair, warc_zip

QUERIES = {
    "op1_byte_bpe": bpe.op1_byte_bpe,
    "op2_toxicity": toxicity.op2_toxicity,
    "op3_minhash": minhash.op3_minhash,
    "op4_secrets": secret_scan.op4_secrets,
    "op5_passages": passages.op5_passages,
    "op6_token_rollup": token_rollup.op6_token_rollup,
    "op7_pii": pii.op7_pii,
    "op8_warc_zip": warc_zip.op8_warc_zip,
    "op9_simhash": simhash.op9_simhash,
    "op10_decontamination": decontam.op10_decontamination,
    "op11_turn_repair": turn_repair.op11_turn_repair,
    "op12_simhash_dedup": simhash_dedup.op12_simhash_dedup,
    "op13_phrases": phrases.op13_phrases,
}
ORACLE: dict[str, str] = {"op3_minhash": minhash.OP3_SQL, "op8_warc_zip": warc_zip.OP8_SQL, "op10_decontamination": decontam.OP10_SQL, "op13_phrases": phrases.OP13_SQL}
