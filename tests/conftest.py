from __future__ import annotations

import datetime as dt
import decimal
import os
import sys
from collections import Counter

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from ledgerloom.config import build_session
    session = build_session(master="local[4]", shuffle_partitions=4)
    yield session
    session.stop()


def norm(v):
    if isinstance(v, float):
        return repr(round(v, 9))
    if isinstance(v, decimal.Decimal):
        return str(v.normalize())
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    return repr(v)


def bag(cols, rows) -> Counter:
    """Order-insensitive multiset of rows, columns sorted by name."""
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return Counter(tuple(norm(r[i]) for i in order) for r in rows)


def spark_bag(df) -> Counter:
    return bag(df.columns, [tuple(r) for r in df.collect()])


def duck_bag(con, sql: str) -> Counter:
    res = con.execute(sql)
    return bag([c[0] for c in res.description], res.fetchall())


def plan_text(df, mode: str = "formatted") -> str:
    """The text ``df.explain(mode)`` prints."""
    import contextlib
    import io
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()
