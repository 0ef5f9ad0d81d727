"""Queries of the training-data operators by name, and SQL with the same result where there is."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from regspan.llm import (
    ann, divergence, html, lexsearch, minhash, mixing, oracles, packing, quality, rules, secrets, suffixes,
    tiers, tokenstore,
)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_suffixes": suffixes.query,
        "op2_secrets": secrets.query,
        "op3_minhash": minhash.query,
        "op4_neighbours": ann.query,
        "op5_quality": quality.query,
        "op6_rules": rules.query,
        "op7_tokens": tokenstore.query,
        "op8_mixing": mixing.query,
        "op9_packing": packing.query,
        "op10_html": html.query,
        "op11_lexsearch": lexsearch.query,
        "op12_divergence": divergence.query,
        "op13_tiers": tiers.query,
        "pipeline": corpus_pipeline.run,
    }


def oracle_sql() -> dict[str, str]:
    return oracles.oracle_sql()
