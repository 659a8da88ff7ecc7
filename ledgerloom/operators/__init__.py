"""Relational operators the builders are made of."""

from .dedup import distinct_rows, keep_first
from .integrity import duplicate_key_count, duplicate_keys, orphan_count, orphan_rows
from .keys import dense_key
from .lookups import Lookup, lookup, lookup_distinct, sized_broadcast

__all__ = ["Lookup", "dense_key", "distinct_rows", "duplicate_key_count", "duplicate_keys",
           "keep_first", "lookup", "lookup_distinct", "orphan_count", "orphan_rows",
           "sized_broadcast"]
