"""The registered queries of this package and their SQL, where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from costmart.llm import alignment, ann, bpe, codebooks, licenses, packing, quality, sharding, simhash, tokenfile, toxicity, warc, winnowing
from costmart.llm.frames import ship_package


def _shipped(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship_package(spark)
        return query(spark, sf_dir)

    return run


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_simhash_bk": _shipped(simhash.query),
    "op2_nnls_packing": _shipped(packing.query),
    "op3_license_scan": _shipped(licenses.query),
    "op4_crf_toxicity": _shipped(toxicity.query),
    "op5_warc_revisits": _shipped(warc.query),
    "op6_certified_rules": _shipped(quality.query),
    "op7_streaming_bpe": _shipped(bpe.query),
    "op8_jump_shards": sharding.query,
    "op10_range_coder": _shipped(tokenfile.query),
    "op9_collision_ann": _shipped(ann.query),
    "op11_fragment_alignment": _shipped(alignment.query),
    "op12_winnowing": _shipped(winnowing.query),
    "op13_active_lloyd": _shipped(codebooks.query),
}

ORACLES: dict[str, str] = {
    "op5_warc_revisits": warc.ORACLE,
    "op8_jump_shards": sharding.ORACLE,
    "op12_winnowing": winnowing.ORACLE,
    "op13_active_lloyd": codebooks.ORACLE,
}
