"""The operators as registered queries, with SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from driftlake.llm import conversation_repair, decontaminate, digest_index, langid, lm, mixing, quality_model
from driftlake.llm import repeats, secrets, simhash, url_rules, vector_codes, warc

REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_langid": langid.op1_langid,
    "op2_warc": warc.op2_warc,
    "op3_simhash": simhash.op3_simhash,
    "op4_lm": lm.op4_lm,
    "op5_exact_dedup": digest_index.op5_exact_dedup,
    "op6_secrets": secrets.op6_secrets,
    "op7_mixing": mixing.op7_mixing,
    "op8_repeats": repeats.op8_repeats,
    "op9_url_rules": url_rules.op9_url_rules,
    "op10_decontamination": decontaminate.op10_decontamination,
    "op11_vector_codes": vector_codes.op11_vector_codes,
    "op12_quality": quality_model.op12_quality,
    "op13_repair": conversation_repair.op13_repair,
    "pipeline": corpus_pipeline.run,
}

ORACLES: dict[str, str] = {
    "op2_warc": warc.ORACLE,
    "op5_exact_dedup": digest_index.ORACLE,
    "op7_mixing": mixing.ORACLE,
    "op9_url_rules": url_rules.ORACLE,
    "op11_vector_codes": vector_codes.ORACLE,
}
