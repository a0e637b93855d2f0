"""What the executed plans must look like at any scale."""

import re

import pytest

from pyspark.sql import Window as W
from pyspark.sql import functions as F

import __spark_entry__ as entry
from catalog.queries import REGISTRY
from catalog.tables import complaint_star
from queixa import session
from queixa.operators.star import Dimension, Star
from queixa.plans import hypotheses
from queixa.plans.datasets import REPORTS, dataset
from tests.plans import executed_plan, scans

ONE_PASS = [n for n in REPORTS if n not in (
    "headline_figures", "executive_sentence", "monthly_evolution", "structural_trend")]


@pytest.mark.parametrize("name", sorted(REPORTS))
def test_reports_read_the_fact_once(spark, sf_dir, name):
    """Time measures read one more column of it, for the calendar's bounds."""
    df = dataset(complaint_star(spark, sf_dir), name)
    assert scans(df, "lineitem") == (1 if name in ONE_PASS else 2)


def test_verdicts_read_the_fact_once(spark, sf_dir):
    frame = complaint_star(spark, sf_dir).frame(hypotheses.HYPOTHESIS_KEYS)
    assert scans(hypotheses.hypotheses(frame, "ASIA"), "lineitem") == 1


# Axes that belong to one dimension: as many combinations as members.
ONE_DIMENSION = [{"operadora", "grupo", "porte"}, {"uf", "estado", "regiao"}, {"categoria", "subcategoria"}]


def wide_windows(plan: str) -> list[str]:
    """Windows over all rows of a grouping by keys of more than one dimension."""
    lines, found = plan.splitlines(), []
    for i, line in enumerate(lines):
        if not re.search(r"[ -]Window \[", line):
            continue
        lists = re.findall(r", \[([^\]]*)\]", line[line.rindex(" AS "):])
        if lists and not re.search(r" (ASC|DESC) ", lists[0]):
            continue  # the first list names what it is partitioned by
        below = next((x for x in lines[i + 1:] if "HashAggregate(keys=" in x or "SortAggregate(key=" in x), "")
        keys = set(re.findall(r"(\w+)#", re.search(r"keys?=\[([^\]]*)\]", below)[1])) if below else set()
        if len(keys) > 1 and not any(keys <= one for one in ONE_DIMENSION):
            found.append(f"{line.strip()[:150]} above {sorted(keys)}")
    return found


@pytest.mark.parametrize("name", sorted(n for n in REGISTRY if n != "etl_from_files" and not n.startswith("kpi_files")))
def test_nothing_runs_in_python_and_nothing_is_paired(spark, sf_dir, name):
    plan = executed_plan(REGISTRY[name](spark, sf_dir))
    assert not re.search(r"Python|Pandas|InArrow|CartesianProduct|BroadcastNestedLoop", plan)
    assert wide_windows(plan) == []


def test_wide_windows_are_seen(spark, sf_dir):
    cells = complaint_star(spark, sf_dir).cube(["uf", "status"])
    summed = cells.withColumn("todos", F.sum("qtd").over(W.partitionBy()))
    assert wide_windows(executed_plan(summed))
    assert not wide_windows(executed_plan(cells.withColumn("todos", F.sum("qtd").over(W.partitionBy("uf")))))
    assert wide_windows(executed_plan(cells.withColumn("lugar", F.rank().over(W.orderBy(F.desc("qtd"))))))


def test_unneeded_tables_are_not_joined(spark, sf_dir):
    plan = executed_plan(dataset(complaint_star(spark, sf_dir), "by_region"))
    assert "orders.parquet" not in plan and "part.parquet" not in plan
    scan = next(line for line in plan.splitlines() if "lineitem.parquet" in line)
    assert re.search(r"ReadSchema: struct<l_suppkey:bigint>", scan)


def test_year_filter_reaches_the_scan(spark, sf_dir):
    star = complaint_star(spark, sf_dir)
    plan = executed_plan(dataset(star, "by_state", {"ano": [1998]}))
    assert "GreaterThanOrEqual(l_shipdate,1998-01-01T00:00)" in plan
    # A series measure looks back one year, no further.
    plan = executed_plan(dataset(star, "headline_figures", {"ano": [1998]}))
    assert "GreaterThanOrEqual(l_shipdate,1997-01-01T00:00)" in plan


def test_windows_over_everything_only_see_aggregates(spark, sf_dir):
    """An unpartitioned window is allowed only above a grouping."""
    for name in ("kpi_consolidated", "kpi_by_operator", "pareto_operator", "zscore_month_flag", "market_structure"):
        plan = executed_plan(entry.queries()[name](spark, sf_dir)).splitlines()
        for i, line in enumerate(plan):
            if "Window [" in line:
                depth = line.index("Window")
                below = [x for x in plan[i + 1:] if x.strip(" :|+-")]
                assert any("HashAggregate" in x for x in below if x.find("HashAggregate") > depth), name


def test_without_broadcast_the_join_is_shuffled_not_dropped(spark, sf_dir):
    """Beyond the threshold the same query shuffles both sides, with the same result."""
    small = [tuple(r) for r in dataset(complaint_star(spark, sf_dir), "operator_panel").collect()]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        df = dataset(complaint_star(spark, sf_dir), "operator_panel")
        plan = executed_plan(df)
        assert re.search("SortMergeJoin|ShuffledHashJoin", plan) and "BroadcastHashJoin" not in plan
        assert [tuple(r) for r in df.collect()] == small
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


def test_a_hot_key_is_split(spark):
    """A third of all complaints share one key and the dimension is too large to broadcast."""
    spread = F.pmod(F.xxhash64("id"), F.lit(3000)).cast("int")
    fact = spark.range(300000).select(
        F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id") % 20000).alias("k"),
        F.date_add(F.lit("2020-01-01").cast("date"), spread).alias("dia"), F.lit(1).cast("long").alias("qtd"))
    lookup = spark.range(-1, 20000).select(
        F.col("id").alias("k"), F.concat(F.lit("op"), (F.col("id") % 5).cast("string")).alias("operadora"))
    star = Star(fact, {"operadora": Dimension(lambda columns: lookup, "k", ("operadora",))}, None, None, "?")
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "150KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100KB",
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        df = star.cube(["operadora", "dia"])
        assert "skew=true" in executed_plan(df)
        assert sum(r.qtd for r in df.collect()) == 300000
    finally:
        for key in settings:
            spark.conf.unset(key)


def test_shuffles_are_sized_from_the_input(spark, sf_dir, monkeypatch):
    lineitem = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    key = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    try:
        assert session.size_shuffles(lineitem) == 8 == int(spark.conf.get(key))
        monkeypatch.setattr(session, "SHUFFLE_SHARE", 2000)
        assert session.size_shuffles(lineitem) == session.stored_size(lineitem) // 2000 > 8
        # A join's estimate multiplies its sides; what counts is what is stored.
        assert session.stored_size(lineitem.join(lineitem, "l_orderkey")) == 2 * session.stored_size(lineitem)
        # Fewer columns, fewer bytes.
        assert session.measured_size(lineitem.select("l_orderkey")) < session.measured_size(lineitem) / 4
        spark.conf.set(session.MOST_SHUFFLE_TASKS, "9")
        assert session.size_shuffles(lineitem) == 9
    finally:
        spark.conf.unset(key)
        spark.conf.unset(session.MOST_SHUFFLE_TASKS)


def test_a_large_dimension_alone_is_joined_to_sums(spark, sf_dir):
    """One shuffle of the fact, of per-key sums, serves both the sums and the join."""
    expected = sorted(map(tuple, dataset(complaint_star(spark, sf_dir), "volume_by_operator").collect()))
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        df = dataset(complaint_star(spark, sf_dir), "volume_by_operator")
        plan = executed_plan(df)
        assert sorted(map(tuple, df.collect())) == expected
        assert re.search(r"HashAggregate\(keys=\[l_orderkey#\d+L\], functions=\[partial_", plan)
        assert len(re.findall(r"Exchange hashpartitioning\(l_orderkey", plan)) == 2  # the sums, and the lookup
    finally:
        for key in settings:
            spark.conf.unset(key)
