"""The corpus operators' queries and, where SQL can express one, its SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from gleanworks.llm import divergence, exponion, hilbert, lines, mixing, packing, quality, quantised, quotes, secrets, simhash, vafile, warc


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_warc": warc.op1_warc,
        "op2_simhash": simhash.op2_simhash,
        "op3_packing": packing.op3_packing,
        "op4_vectors": quantised.op4_vectors,
        "op5_quality": quality.op5_quality,
        "op6_sharding": hilbert.op6_sharding,
        "op7_mixing": mixing.op7_mixing,
        "op8_search": vafile.op8_search,
        "op9_secrets": secrets.op9_secrets,
        "op10_quotes": quotes.op10_quotes,
        "op11_lines": lines.op11_lines,
        "op12_divergence": divergence.op12_divergence,
        "op13_codes": exponion.op13_codes,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op1_warc": warc.OP1_SQL,
        "op4_vectors": quantised.OP4_SQL,
        "op8_search": vafile.OP8_SQL,
        "op11_lines": lines.OP11_SQL,
        "op12_divergence": divergence.OP12_SQL,
        "op13_codes": exponion.OP13_SQL,
    }
