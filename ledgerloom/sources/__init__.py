"""Raw inputs: file readers and the test-table fixture."""

from . import fixtures
from .readers import clean_raw_orders, conform, read_sheet, read_sheet_with_rejects, rename_headers

__all__ = ["clean_raw_orders", "conform", "fixtures", "read_sheet",
           "read_sheet_with_rejects", "rename_headers"]
