"""Registered queries of the operators: ``(spark, sf_dir) -> DataFrame``, and their DuckDB SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import chat, lm, merkle, mixing, neardup, packing, pii, quality, search, simhash, substrings, toxicity, urls

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {
    "op1_quality": quality.op1_quality,
    "op2_toxicity": toxicity.op2_toxicity,
    "op3_neardup": neardup.op3_neardup,
    "op4_rotate": chat.op4_rotate,
    "op5_pack": packing.op5_pack,
    "op6_substrings": substrings.op6_substrings,
    "op7_simhash": simhash.op7_simhash,
    "op8_urls": urls.op8_urls,
    "op9_lm": lm.op9_lm,
    "op10_mix": mixing.op10_mix,
    "op11_pii": pii.op11_pii,
    "op12_search": search.op12_search,
    "op13_manifest": merkle.op13_manifest,
}

ORACLES: dict[str, str] = {
    "op3_neardup": neardup.ORACLE,
    "op4_rotate": chat.ORACLE,
    "op6_substrings": substrings.ORACLE,
    "op10_mix": mixing.ORACLE,
    "op12_search": search.ORACLE,
    "op13_manifest": merkle.ORACLE,
}
