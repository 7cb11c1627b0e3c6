"""Data quality, star-schema loading and panel analytics on Spark."""

from .functions.rules import Bounds, Rule, annotate, sales_rules, warning_rules
from .operators.evaluate import bootstrap_interval, brier, model_table, roc_auc, threshold_metrics
from .operators.ordered import average_ranks, dense_numbers, running_total
from .operators.selection import exact_quantiles
from .operators.panel import label_next_period, with_split
from .operators.quality import error_rows, metrics, split
from .plans.control import BatchLog, DeadLetters, MarkStore
from .plans.mart import Mart, MartConfig
from .session import build_session
from .sources.files import scan_dictionary, scan_macro, scan_transactions, summarise
from .streaming.ingest import file_stream, ingest_stream
from .streaming.rollup import Rollup, weekly_rollup

__all__ = [
    "BatchLog",
    "Bounds",
    "DeadLetters",
    "MarkStore",
    "Mart",
    "MartConfig",
    "Rollup",
    "Rule",
    "annotate",
    "average_ranks",
    "bootstrap_interval",
    "brier",
    "build_session",
    "dense_numbers",
    "error_rows",
    "exact_quantiles",
    "file_stream",
    "ingest_stream",
    "label_next_period",
    "metrics",
    "model_table",
    "roc_auc",
    "running_total",
    "sales_rules",
    "scan_dictionary",
    "scan_macro",
    "scan_transactions",
    "split",
    "summarise",
    "threshold_metrics",
    "warning_rules",
    "weekly_rollup",
    "with_split",
]
