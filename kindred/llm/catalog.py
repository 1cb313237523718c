"""The queries of this subpackage and the SQL for those that SQL can express."""

from __future__ import annotations

from . import ann, bpe, fingerprint, langid, linededup, lm, minhash, mixing, quality, toxicity


def queries() -> dict:
    return {f.__name__: f for f in (langid.op1_langid, bpe.op2_bpe, linededup.op3_linededup, minhash.op4_minhash, mixing.op5_mixing, fingerprint.op6_fingerprint, toxicity.op7_toxicity, quality.op8_quality, ann.op9_ann, lm.op10_lm)}


def oracle_sql() -> dict[str, str]:
    return {"op4_minhash": minhash.SQL}
