"""The subpackage's registered queries and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ledgerloom.llm.op1_quality_knn import op1_quality_knn
from ledgerloom.llm.op2_multi_index_hashing import op2_multi_index_hashing
from ledgerloom.llm.op3_wavelet_tokens import op3_wavelet_tokens
from ledgerloom.llm.op4_retrieval_packing import op4_retrieval_packing
from ledgerloom.llm.op5_weak_supervision import op5_weak_supervision
from ledgerloom.llm.op6_language_id import op6_language_id
from ledgerloom.llm.op7_simhash_dedup import op7_simhash_dedup
from ledgerloom.llm.op8_source_mixing import op8_source_mixing
from ledgerloom.llm.op9_suffix_dedup import op9_suffix_dedup
from ledgerloom.llm import op11_va_file as _op11
from ledgerloom.llm import op12_gnat_codes as _op12
from ledgerloom.llm import op13_segment_negatives as _op13
from ledgerloom.llm.op10_license_scan import op10_license_scan


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = (op1_quality_knn, op2_multi_index_hashing, op3_wavelet_tokens, op4_retrieval_packing, op5_weak_supervision,
             op6_language_id, op7_simhash_dedup, op8_source_mixing, op9_suffix_dedup, op10_license_scan,
             _op11.op11_va_file, _op12.op12_gnat_codes, _op13.op13_segment_negatives, pipeline)
    return {f.__name__: f for f in found}


def oracle_sql() -> dict[str, str]:
    return {"op11_va_file": _op11.SQL, "op12_gnat_codes": _op12.SQL, "op13_segment_negatives": _op13.SQL}
