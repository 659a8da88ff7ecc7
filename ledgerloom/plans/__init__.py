"""Table builders, the end-to-end pipeline, checks, views and publishing."""

from . import entities, normalize, publish, validate, views
from .normalize import Normalizer, flat_load
from .normalize import normalize as normalize_tables
from .publish import run_and_publish
from .validate import validation_report
from .views import sales_by_region_category, sales_view

__all__ = ["Normalizer", "entities", "flat_load", "normalize", "normalize_tables", "publish",
           "run_and_publish", "sales_by_region_category", "sales_view", "validate",
           "validation_report", "views"]
