"""Physical-plan checks used by tests and while tuning (explain text only)."""

from __future__ import annotations

import contextlib
import io
import re

from pyspark.sql import DataFrame


def plan_text(df: DataFrame, mode: str = "formatted") -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode=mode)
    return buf.getvalue()


def count_nodes(df: DataFrame, pattern: str) -> int:
    """Occurrences of a node name (regex) in the plan tree part of the formatted explain."""
    tree = plan_text(df).split("\n\n(")[0]
    return len(re.findall(pattern, tree))


def shuffle_count(df: DataFrame) -> int:
    """Exchanges in the main plan (scalar subqueries are planned separately)."""
    return count_nodes(df, r"\bExchange \(")


def python_nodes(df: DataFrame) -> int:
    return len(re.findall(r"BatchEvalPython|ArrowEvalPython|FlatMapGroupsInPandas|MapInPandas|PythonUDF", plan_text(df)))
