"""The queries of this folder, and their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .chat import op4_budgeted_windows
from .chunk_bpe import op6_chunk_reuse
from .forest_join import op2_forest_join
from .kneser_ney import op12_kneser_ney
from .mixing import op7_entropy_mixing
from .pii import op10_pii_spans
from .prefix_counts import op3_prefix_counts
from .quality import OP1_SQL, op1_robust_outliers
from .runs import op11_periodic_runs
from .topk import OP8_SQL, op8_exact_topk
from .url_filter import OP5_SQL, op5_redirect_equivalence
from .warc_zip import OP9_SQL, op9_zip_archives
from .whitening import op13_embedding_whitening

QUERIES = [op1_robust_outliers, op2_forest_join, op3_prefix_counts, op4_budgeted_windows, op5_redirect_equivalence, op6_chunk_reuse, op7_entropy_mixing,
           op8_exact_topk, op9_zip_archives, op10_pii_spans, op11_periodic_runs, op12_kneser_ney, op13_embedding_whitening]
SQL = {"op1_robust_outliers": OP1_SQL, "op5_redirect_equivalence": OP5_SQL, "op8_exact_topk": OP8_SQL, "op9_zip_archives": OP9_SQL}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in QUERIES}


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
