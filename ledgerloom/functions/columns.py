"""Column expressions used while cleaning raw rows.

Every function returns a ``Column`` built from ``pyspark.sql.functions`` so the
work stays inside whole-stage codegen; nothing here runs Python per row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import NA_MARKERS, POSTAL_DEFAULT, POSTAL_WIDTH

ColumnOrName = Column | str


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def na_to_null(c: ColumnOrName, markers: tuple[str, ...] = NA_MARKERS) -> Column:
    """Text cells equal to a missing-value marker become NULL (exact match)."""
    c = _col(c)
    return F.when(c.isin(*markers), F.lit(None).cast("string")).otherwise(c)


def parse_locale_number(c: ColumnOrName, thousands: str = " ", decimal: str = ",",
                        strict: bool = False) -> Column:
    """Text such as ``'1 234,56'`` → 1234.56.

    The thousands separator (and the no-break space) is removed and the decimal
    mark becomes ``'.'``. Text that is not a number becomes NULL, or raises when
    ``strict``.
    """
    text = F.regexp_replace(_col(c).cast("string"), f"[{thousands} ]", "")
    if decimal != ".":
        text = F.replace(text, F.lit(decimal), F.lit("."))
    return text.cast("double") if strict else text.try_cast("double")


def postal_normalize(c: ColumnOrName, lenient: bool = False) -> Column:
    """Numeric postal code → zero-padded text.

    NULL → ``'00000'``; 2101.0 → ``'02101'``; 90210.9 → ``'90210'`` (truncation);
    codes longer than five digits stay whole (plain ``lpad`` would cut them);
    a negative code keeps its sign in front of the padding. Text that is not a
    number raises, or stays as it is when ``lenient``, so that different codes
    never become one.
    """
    c = _col(c)
    as_num = c.try_cast("double") if lenient else c.cast("double")
    digits = F.coalesce(as_num, F.lit(0.0)).cast("bigint").cast("string")
    if lenient:
        digits = F.when(c.isNull() | as_num.isNotNull(), digits)
    text = c.cast("string")
    negative = digits.startswith("-")
    padded = F.when(negative, F.concat(F.lit("-"), F.lpad(F.substring(digits, 2, 64), POSTAL_WIDTH - 1, "0"))) \
              .otherwise(F.lpad(digits, POSTAL_WIDTH, "0"))
    out = F.when(F.length(digits) < POSTAL_WIDTH, padded).otherwise(digits)
    return F.coalesce(out, text) if lenient else out


def postal_or_default(c: ColumnOrName) -> Column:
    """Text postal code with the default for NULL (used in the lookup key)."""
    return F.coalesce(_col(c), F.lit(POSTAL_DEFAULT))


def parse_timestamp(c: ColumnOrName, fmt: str | tuple[str, ...] | None = None,
                    lenient: bool = False) -> Column:
    """Datetime-like text (or timestamp) → zone-less timestamp.

    ``fmt`` is one pattern or several tried in turn (e.g. ``("M/d/yyyy",
    "yyyy-MM-dd HH:mm:ss")``); with several, ISO text is also accepted. Text
    that no pattern reads raises, or becomes NULL when ``lenient``.
    """
    c = _col(c)
    if fmt is None:
        return c.try_cast("timestamp_ntz") if lenient else c.cast("timestamp_ntz")
    if isinstance(fmt, str):
        if lenient:
            return _zoneless(c, fmt)
        return F.to_timestamp_ntz(c, F.lit(fmt))
    text = c.cast("string")
    parsed = F.coalesce(text.try_cast("timestamp_ntz"), *[_zoneless(text, f) for f in fmt])
    if lenient:
        return parsed
    bad = F.concat(F.lit("unreadable date: "), text)
    return F.when(text.isNotNull() & parsed.isNull(), F.raise_error(bad).cast("timestamp_ntz")) \
            .otherwise(parsed)


def _zoneless(text: Column, fmt: str) -> Column:
    """NULL for text that ``fmt`` doesn't read. The text is read and printed in the
    same zone, UTC, whatever the session's, so that no midnight is shifted by a
    change of clocks."""
    at = F.try_to_timestamp(F.concat(text, F.lit(" +0000")), F.lit(f"{fmt} Z"))
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.timestamp_add("MICROSECOND", F.unix_micros(at), epoch)


def format_timestamp(c: ColumnOrName, fmt: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    """Timestamp → text; NULL stays NULL (export only)."""
    return F.date_format(_col(c), fmt)


def to_store_decimal(c: ColumnOrName, decimal_type: str) -> Column:
    """Exact store type; rounds half away from zero, raises on overflow (ANSI)."""
    return _col(c).cast(decimal_type)


def sentinel(c: ColumnOrName, marker: str = "-") -> Column:
    """Export form of a nullable value: NULL becomes a marker text."""
    return F.coalesce(_col(c).cast("string"), F.lit(marker))
