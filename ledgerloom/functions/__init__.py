"""Column-level functions (cleaning, parsing, store casts)."""

from .columns import (format_timestamp, na_to_null, parse_locale_number, parse_timestamp,
                      postal_normalize, postal_or_default, sentinel, to_store_decimal)

__all__ = ["format_timestamp", "na_to_null", "parse_locale_number", "parse_timestamp",
           "postal_normalize", "postal_or_default", "sentinel", "to_store_decimal"]
