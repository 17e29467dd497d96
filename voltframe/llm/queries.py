"""Queries of the training-data operators, by name, and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from voltframe.llm.ann import op7_collision_ann
from voltframe.llm.bpe import op12_byte_bpe
from voltframe.llm.common import on_workers
from voltframe.llm.html import op4_html_text
from voltframe.llm.lines import OP5_SQL, op5_line_dedup
from voltframe.llm.mixing import op6_soft_mixing
from voltframe.llm.packing import op8_pack_pow2
from voltframe.llm.periodic import op11_periodic_runs
from voltframe.llm.pq import op2_pq_dedup
from voltframe.llm.quality import op10_ordinal_quality
from voltframe.llm.secrets import op1_secret_scan
from voltframe.llm.simhash import op9_simhash_dedup
from voltframe.llm.spelling import op13_spelling_variants
from voltframe.llm.substring import op3_rlz_substring_dedup


def _query(run: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    @wraps(run)
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        on_workers(spark)
        return run(spark, sf_dir)
    return query


QUERIES = {run.__name__: _query(run) for run in (
    op1_secret_scan, op2_pq_dedup, op3_rlz_substring_dedup, op4_html_text, op5_line_dedup, op6_soft_mixing,
    op7_collision_ann, op8_pack_pow2, op9_simhash_dedup, op10_ordinal_quality,
    op11_periodic_runs, op12_byte_bpe, op13_spelling_variants)}

#: The others can't be said in SQL at all, or only with work that is quadratic
#: in the table; tests hold them against brute force.
ORACLE = {"op5_line_dedup": OP5_SQL}
