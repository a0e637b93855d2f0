"""Reading executed plans."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame


def executed_plan(df: DataFrame) -> str:
    """The plan as it ran, without the adaptive planner's first drafts."""
    df.collect()
    kept, skip_from = [], None
    for line in df._jdf.queryExecution().executedPlan().toString().splitlines():
        depth = re.search(r"[A-Za-z=*]", line)
        depth = depth.start() if depth else 0
        if skip_from is not None and depth >= skip_from:
            continue
        skip_from = None
        if "== Initial Plan ==" in line:
            skip_from = depth
            continue
        kept.append(line)
    return "\n".join(kept)


def scans(df: DataFrame, table: str) -> int:
    """How many separate readings of a table the executed plan holds."""
    readings = set()
    for line in executed_plan(df).splitlines():
        if "FileScan" in line and f"/{table}.parquet" in line:
            readings.add(line.strip(" :|+-"))
    return len(readings)
