"""Static guards on the library source: constructs that do not scale stay out."""

from __future__ import annotations

import pathlib
import re

PACKAGE = pathlib.Path(__file__).resolve().parent.parent / "ledgerloom"

FORBIDDEN = {
    r"\blocalCheckpoint\b": "lineage is cut by written tables in the shared folder",
    r"\bcrossJoin\b": "no cross joins",
    r"\budf\(|pandas_udf|applyInPandas|mapInPandas": "no Python on row data",
    r"\.collect\(\)|toPandas\(": "no whole results through the driver",
    r"\.limit\(": "no row caps",
}


def _code_lines():
    for path in sorted(PACKAGE.rglob("*.py")):
        if "llm" in path.relative_to(PACKAGE).parts:  # Python operators with rules of their own
            continue
        in_doc = False
        for no, line in enumerate(path.read_text().splitlines(), 1):
            stripped = line.strip()
            if stripped.count('"""') == 1:
                in_doc = not in_doc
                continue
            if in_doc or stripped.startswith("#") or stripped.startswith('"""'):
                continue
            yield path.relative_to(PACKAGE.parent), no, line


def test_no_forbidden_constructs():
    hits = [f"{p}:{n}: {line.strip()}  ({why})"
            for p, n, line in _code_lines()
            for pattern, why in FORBIDDEN.items() if re.search(pattern, line)]
    assert hits == []


def test_window_without_partition_only_over_bounded_rows():
    """A window with no PARTITION BY (one task) appears only where its input is
    bounded: per-partition counts in the key builder, report rows in validation."""
    allowed = {"ledgerloom/operators/keys.py", "ledgerloom/plans/validate.py"}
    users = {str(p) for p, _, line in _code_lines()
             if "Window.orderBy(" in line or "Window.partitionBy()" in line}
    assert users <= allowed
