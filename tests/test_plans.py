"""What the physical plans must and must not hold."""

import pytest
from pyspark.sql import functions as F

from bronzeway.operators import profile, ranking
from bronzeway.plans import accidents, roles
from bronzeway.plans.queries import QUERIES
from bronzeway.session import scratch_path
from bronzeway.sources.tables import read_table

SF_DIR = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_workers_and_no_cross_joins(spark, name):
    text = plan(QUERIES[name](spark, SF_DIR))
    for operator in ("Python", "CartesianProduct", "BroadcastNestedLoopJoin", "Pandas"):
        assert operator not in text


def test_silver_has_no_shuffle(spark):
    text = plan(accidents.to_silver(roles.frame(spark, SF_DIR, roles.RAW)))
    assert "Exchange" not in text


def test_gold_has_one_shuffle_after_a_partial_aggregate(spark):
    path = scratch_path(spark, "silver")
    roles.frame(spark, SF_DIR, roles.SILVER).write.parquet(path)
    text = plan(accidents.to_gold(read_table(spark, path)))
    assert text.count("Exchange hashpartitioning") == 1
    assert text.count("partial_count(1)") == 1


def test_years_and_choices_reach_the_scan(spark):
    path = scratch_path(spark, "gold")
    roles.frame(spark, SF_DIR, roles.GOLD).write.parquet(path)
    chosen = accidents.selection(read_table(spark, path), (1996, 1997), ["5-LOW"])
    text = plan(accidents.cards(chosen))
    pushed = text[text.index("PushedFilters"):]
    assert "GreaterThanOrEqual(DATA,1996-01-01)" in pushed
    assert "LessThanOrEqual(DATA,1997-12-31)" in pushed
    assert "EqualTo(DS_TIPO,5-LOW)" in pushed or "In(DS_TIPO" in pushed
    assert "SG_UF" not in text[text.index("ReadSchema"):]


def test_profiles_scan_once(spark):
    path = scratch_path(spark, "raw")
    roles.frame(spark, SF_DIR, roles.RAW).write.parquet(path)
    text = plan(accidents.value_profile(read_table(spark, path)))
    assert text.count("FileScan") == 1 and text.count("Exchange hashpartitioning") == 1


def test_first_values_are_ranked_in_parts(spark):
    df = spark.range(100_000).selectExpr("id AS a", "id % 7 AS b")
    got = profile.profile_values(df, ["a", "b"], 1001)
    text = plan(got)
    ranks = [line for line in text.splitlines() if " Window [" in line]
    assert len(ranks) == 2 and sum("_part" in line for line in ranks) >= 1
    rows = got.collect()
    first = sorted(str(i) for i in range(100_000))[:1001]
    assert sorted(r.value for r in rows if r.column == "a") == first
    assert sorted(r.value for r in rows if r.column == "b") == list("0123456")


def test_places_are_given_without_one_task_for_all(spark):
    df = spark.range(10_000).withColumn("key", F.col("id") % 3)
    text = plan(ranking.with_position(df, ["key"]))
    for operator in ("Window", "SinglePartition", "Join"):
        assert operator not in text
    placed = ranking.with_position(df, ["key"])
    assert placed.select(F.max("position")).first()[0] == 10_000
