"""ledgerloom — Spark-native normalization and reconciliation of flat sales data.

Flat sales rows (order lines, region managers, returned orders) become nine
third-normal-form tables with dense, reproducible surrogate keys; a
validation job reconciles row counts, keys, foreign keys and control totals,
and a run is published only when every check passes.
"""

from .config import build_session, checkpoint_root, stage_path
from .plans import (Normalizer, flat_load, normalize_tables, run_and_publish,
                    sales_by_region_category, sales_view, validation_report)
from .schemas import FOREIGN_KEYS, TABLE_ORDER, TABLES

__all__ = ["FOREIGN_KEYS", "Normalizer", "TABLES", "TABLE_ORDER", "build_session",
           "checkpoint_root", "flat_load", "normalize_tables", "run_and_publish",
           "sales_by_region_category", "sales_view", "stage_path", "validation_report"]
