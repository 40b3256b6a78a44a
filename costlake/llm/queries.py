"""Queries of this subpackage for the driver, and their SQL where there is any."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from costlake.llm import ann, bpe, chaining, imatch, jaccard, langid, negatives, packing, periodic, pii, quality, suffix, toxicity

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_suffix": suffix.op1,
    "op2_ann": ann.op2,
    "op3_langid": langid.op3,
    "op4_bpe": bpe.op4,
    "op5_packing": packing.op5,
    "op6_chaining": chaining.op6,
    "op7_imatch": imatch.op7,
    "op8_jaccard": jaccard.op8,
    "op9_pii": pii.op9,
    "op10_toxicity": toxicity.op10,
    "op11_periodic": periodic.op11,
    "op12_negatives": negatives.op12,
    "op13_quality": quality.op13,
}
SQL: dict[str, str] = {
    "op1_suffix": suffix.SQL,
    "op8_jaccard": jaccard.SQL,
    "op12_negatives": negatives.SQL,
    "op13_quality": quality.SQL,
}
