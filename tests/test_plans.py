"""What the physical plans must and must not contain."""

import pytest
from pyspark.sql import functions as F

from sensorloom.operators.documents import measurement_documents
from sensorloom.operators.enrich import enrich_measure
from sensorloom.operators.reports import bad_records
from sensorloom.plans import registry
from sensorloom.plans.tables import Tables

FOLDER = "/root/testdata/sf0.001"
PYTHON_NODES = ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroupsInPandas")


def formatted(df, capsys):
    capsys.readouterr()
    df.explain("formatted")
    return capsys.readouterr().out


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_no_python_and_no_cross_join(spark, capsys, name):
    plan = formatted(registry.queries()[name](spark, FOLDER), capsys)
    assert not any(node in plan for node in (*PYTHON_NODES, "CartesianProduct", "NestedLoop"))


def test_small_lookups_are_broadcast_and_pruned(spark, capsys):
    plan = formatted(Tables(spark, FOLDER).enriched, capsys)
    assert plan.count("BroadcastHashJoin") >= 2 and "SortMergeJoin" not in plan
    assert "l_returnflag" not in plan and "p_brand" not in plan


def test_large_lookups_are_shuffled(spark, capsys):
    t = Tables(spark, FOLDER)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        large = enrich_measure(t.measurement, t.station, t.item, max_rows=2)
        assert "SortMergeJoin" in formatted(large, capsys)
        assert large.count() == t.enriched.count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def scans(df, column):
    """How often the plan reads a table with the column."""
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    return sum("Relation" in line and f"{column}#" in line for line in plan.splitlines())


def test_large_lookups_read_the_fact_once(spark):
    assert scans(registry.queries()["enrich_measure_shuffled"](spark, FOLDER), "l_orderkey") == 1


def test_filters_and_columns_reach_the_scan(spark, tmp_path, capsys):
    t = Tables(spark, FOLDER)
    path = str(tmp_path / "enriched")
    t.enriched.write.parquet(path)
    stored = spark.read.parquet(path)
    bad = formatted(bad_records(stored), capsys)
    assert "PushedFilters: [IsNotNull(Status), EqualTo(Status,Bad)]" in bad
    assert "Address" not in bad and "Latitude" not in bad
    day = measurement_documents(stored).filter(F.col("ts") >= "2000-01-01").select("avg")
    assert "GreaterThanOrEqual(Measurement_Date" in formatted(day, capsys)


def test_date_filter_passes_the_enrichment(spark, tmp_path, capsys):
    t = Tables(spark, FOLDER)
    path = str(tmp_path / "measurement")
    t.measurement.write.parquet(path)
    enriched = enrich_measure(spark.read.parquet(path), t.station, t.item)
    plan = formatted(enriched.filter(F.col("Measurement_Date") >= "2000-01-01"), capsys)
    assert "GreaterThanOrEqual(Measurement_Date" in plan


@pytest.mark.parametrize(
    "name", ["validate_summary", "graph_key_audit", "graph_vertices", "graph_paths", "hot_spots", "daily_avg"]
)
def test_the_fact_is_read_once_where_several_results_share_it(spark, name):
    """What a query stores first takes one more scan."""
    assert scans(registry.queries()[name](spark, FOLDER), "l_orderkey") <= 1
