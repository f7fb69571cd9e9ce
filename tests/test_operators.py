import datetime
import random
import time
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from bronzeway.operators import (
    clean,
    filters,
    geo,
    joins,
    profile,
    ranking,
    rollup,
    schema,
)


def rows(df):
    return [tuple(r) for r in df.collect()]


# --- schema ----------------------------------------------------------------


def test_union_drifting(spark):
    a = spark.createDataFrame([("1", "x")], "id string, UOP string")
    b = spark.createDataFrame([("n", "2", "y")], "new string, ID string, uop string")
    union = schema.union_drifting([a, b])
    assert union.columns == ["id", "uop", "new"]
    assert sorted(rows(union)) == [("1", "x", None), ("2", "y", "n")]


def test_common_columns_and_presence(spark):
    sources = {"f1": ["a", "b"], "f2": ["b", "c"], "f3": ["c", "b"]}
    assert rows(schema.common_columns(spark, sources)) == [("b",)]
    assert sorted(rows(schema.column_presence(spark, sources))) == [("a", 1), ("b", 3), ("c", 2)]
    # An empty intersection stays empty, whatever comes after it.
    assert rows(schema.common_columns(spark, {"f1": ["a"], "f2": ["b"], "f3": ["b"]})) == []


def test_describe_schema(spark):
    df = spark.createDataFrame([(1, "x")], "id bigint, name string")
    assert rows(schema.describe_schema(df)) == [(1, "id", "bigint"), (2, "name", "string")]
    assert rows(schema.describe_schema(df, "f.csv"))[0] == ("f.csv", 1, "id", "bigint")


def test_sample(spark):
    df = spark.range(20000).withColumn("k", F.col("id").cast("string"))
    assert rows(schema.sample_rows(df, 0.05, 214)) == rows(schema.sample_rows(df, 0.05, 214))
    keyed = {r[0] for r in rows(schema.sample_rows(df, 0.05, 214, "k"))}
    again = {r[0] for r in rows(schema.sample_rows(df.repartition(7), 0.05, 214, "k"))}
    assert keyed == again and 800 < len(keyed) < 1200
    assert keyed != {r[0] for r in rows(schema.sample_rows(df, 0.05, 215, "k"))}


def test_peek(spark):
    df = spark.range(100)
    assert schema.peek(df, 7).count() == 7
    assert rows(schema.peek(df.orderBy(F.desc("id")), 2, ["id"])) == [(0,), (1,)]


# --- cleaning --------------------------------------------------------------


def test_recode_by_table_keeps_the_row_count(spark):
    df = spark.createDataFrame([("a",), ("b",), ("c",), (None,), ("d",)], "c string")
    mapping = spark.createDataFrame(
        [("a", "1"), ("a", "2"), ("b", None), ("d", "9"), (None, "x")], "old string, new string"
    )
    assert sorted(rows(clean.recode(df, "c", mapping)), key=str) == sorted(
        [("1",), (None,), ("c",), (None,), ("9",)], key=str
    )
    assert sorted(rows(clean.recode(df, "c", mapping, "null", ["d"])), key=str) == sorted(
        [("1",), (None,), (None,), (None,), (None,)], key=str
    )


def test_named_steps(spark):
    df = spark.createDataFrame([("NA", "X-feira", "1,5", "2.7", "7")], "a string, b string, c string, d string, e string")
    df = clean.replace_null_tokens(df, "a", "none")
    df = clean.strip_lowered(df, ["b"], "-feira")
    df = clean.parse_int(clean.parse_decimal_comma(df, "c"), "d")
    df = clean.zero_pad_code(df, "e", 3)
    assert rows(df) == [("none", "x", 1.5, 2, "007")]
    assert [t for _, t in df.dtypes] == ["string", "string", "float", "int", "string"]


def test_with_year(spark):
    df = spark.createDataFrame([("2017-03-01",), (None,)], "d string")
    assert rows(clean.with_year(df, "d", "y").select("y")) == [(2017,), (None,)]


# --- rollups ---------------------------------------------------------------


def test_gold_rollup(spark):
    df = spark.createDataFrame(
        [("x", None, None), ("x", 0, None), ("x", 2, None), (None, 1, 3)],
        "k string, m int, p int",
    )
    gold = rollup.gold_rollup(df, {"K": "k"}, "N", {"WITH_M": "m"}, {"M": "m", "P": "p"})
    assert dict(gold.dtypes) == {
        "K": "string", "N": "bigint", "WITH_M": "bigint", "M": "bigint", "P": "bigint",
    }
    assert sorted(rows(gold), key=str) == sorted(
        [("x", 3, 1, 2, None), (None, 1, 1, 1, 3)], key=str
    )


def test_reporting_sums(spark):
    df = spark.createDataFrame(
        [("a", 1, 0), ("a", None, 0), ("b", None, None), (None, 9, 9), ("c", 1, 4)],
        "k string, m int, n int",
    )
    assert sorted(rows(rollup.sum_by(df, ["m"], ["k"]))) == [("a", 1), ("b", 0), ("c", 1)]
    rates = rollup.rate_by(df, "k", "m", "n", "r")
    assert sorted((r.k, r.r) for r in rates.collect()) == [
        ("a", float("inf")), ("b", None), ("c", 0.25),
    ]
    assert rows(ranking.top_table(rates, "k", "r", 3)) == [
        ("a", float("inf")), ("c", 0.25), ("b", None),
    ]
    assert rows(rollup.kpi(df, ["m", "n"])) == [(11, 13)]
    assert rows(rollup.kpi(df.limit(0), ["m", "n"])) == [(0, 0)]


# --- filters ---------------------------------------------------------------


@pytest.fixture
def gold(spark):
    return spark.createDataFrame(
        [
            (datetime.date(2007, 1, 1), "SP", "101"),
            (datetime.date(2008, 12, 31), "MG", None),
            (datetime.date(2010, 6, 1), None, "116"),
            (None, "SP", "101"),
        ],
        "d date, uf string, br string",
    )


def test_filter_without_selection_keeps_all(gold):
    assert filters.facet_filter(gold, selections={"uf": [], "br": ()}).count() == 4


def test_filter_years_are_inclusive_and_drop_missing_dates(gold):
    got = filters.facet_filter(gold, "d", (2007, 2008))
    assert sorted(r.uf for r in got.collect()) == ["MG", "SP"]


def test_filter_selection(gold):
    def kept(**chosen):
        return filters.facet_filter(gold, selections=chosen).count()

    assert kept(uf=["SP"]) == 2
    assert kept(uf=["SP"], br=["116"]) == 0
    assert kept(uf=["SP", None]) == 3
    assert kept(uf=[None]) == 1


@pytest.mark.parametrize("n", [1, 1000, 1001])
@pytest.mark.parametrize("kind", ["int", "date", "string"])
def test_selections_take_the_type_of_the_column(spark, n, kind):
    first = "timestampadd(DAY, cast(id AS int), DATE'2000-01-01')"
    made = {"int": "id", "date": first, "string": "id"}[kind]
    df = spark.range(1500).selectExpr(f"cast({made} AS {kind}) AS c").union(
        spark.sql(f"SELECT cast(NULL AS {kind})")
    )
    chosen = [r.c for r in df.selectExpr("cast(c AS string) AS c").limit(n).collect()] + ["x y"]
    assert filters.facet_filter(df, selections={"c": chosen}).count() == n
    assert filters.facet_filter(df, selections={"c": [*chosen, None]}).count() == n + 1


def test_facets(gold):
    assert sorted(rows(filters.facets(gold, ["uf", "br"])), key=str) == sorted(
        [("uf", "SP"), ("uf", "MG"), ("uf", None), ("br", "101"), ("br", "116"), ("br", None)],
        key=str,
    )
    assert rows(filters.year_bounds(gold, "d")) == [(2007, 2010)]


# --- join ------------------------------------------------------------------


def test_aggregate_and_join(spark):
    df = spark.createDataFrame(
        [("a", 2), ("a", 3), ("b", 1), (None, 9), ("z", 1)], "k string, n int"
    )
    dim = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3), ("q", 4), (None, 5)], "id string, x int")
    got = joins.aggregate_and_join(df, dim, "n", "k", "id")
    assert got.columns == ["id", "x", "k", "n"]
    assert sorted(rows(got)) == [("a", 1, "a", 5), ("a", 2, "a", 5), ("b", 3, "b", 1)]
    assert {r.k for r in joins.aggregate_and_join(df, dim, "n", "k", "id", 1).collect()} == {"a"}


# --- ranking ---------------------------------------------------------------


@pytest.mark.parametrize("groups", [0, 3, 10, 12, 40])
def test_top_n_with_others(spark, groups):
    data = [(f"k{i:02}", (i * 7) % 11 + 1) for i in range(groups)]
    df = spark.createDataFrame(data, "k string, n bigint")
    got = rows(ranking.top_n_with_others(df, "k", "n"))
    ordered = sorted(data, key=lambda r: (-r[1], r[0]))
    total = sum(n for _, n in data)
    expected = [*ordered[:10], ("Outros", sum(n for _, n in ordered[10:]))]
    assert [r[:2] for r in got] == expected
    if total:
        assert sum(r[2] for r in got) == pytest.approx(1)
        assert [r[2] for r in got] == pytest.approx([n / total for _, n in expected])


def test_a_label_may_be_called_like_the_remainder(spark):
    df = spark.createDataFrame([("Outros", 5), ("a", 3), ("b", 2)], "k string, n bigint")
    got = [r[:2] for r in rows(ranking.top_n_with_others(df, "k", "n", n=2))]
    assert got == [("Outros", 5), ("a", 3), ("Outros", 2)]


def test_flag_max_marks_all_ties(spark):
    df = spark.createDataFrame([("a", 5), ("b", 5), ("c", 1)], "k string, n int")
    assert [r.is_max for r in ranking.flag_max(df, "n").collect()] == [True, True, False]


def test_shares(spark):
    df = spark.createDataFrame([("a", 3), ("b", 1)], "k string, n int")
    assert sorted(rows(ranking.share_of_total(df, "n", "s"))) == [("a", 3, 0.75), ("b", 1, 0.25)]


def test_classes(spark):
    df = spark.createDataFrame([(0,), (1,), (5,), (11,), (12,)], "n int")
    got = {r[0]: r[1] for r in rows(ranking.classify_equal_width(df, "n"))}
    assert got == {0: 1, 1: 1, 5: 3, 11: 6, 12: 6}
    same = spark.createDataFrame([(4,), (4,)], "n int")
    assert [r[1] for r in rows(ranking.classify_equal_width(same, "n"))] == [1, 1]
    assert [r[1] for r in rows(ranking.minmax_scale(same, "n"))] == [0.0, 0.0]
    breaks = rows(ranking.class_breaks(df, "n"))
    assert breaks == [(i, 2.0 * i) for i in range(7)]


# --- profiles --------------------------------------------------------------


def test_profiles(spark):
    df = spark.createDataFrame(
        [("1,5", "a"), ("22", "a"), ("33", None), (None, "b")], "x string, y string"
    )
    assert sorted(rows(profile.profile_formats(df, ["x"])), key=str) == sorted(
        [("x", "D,D", 1), ("x", "DD", 2), ("x", None, 1)], key=str
    )
    assert sorted(rows(profile.profile_values(df, ["x", "y"], 1)), key=str) == sorted(
        [("x", None, 1), ("y", None, 1)], key=str
    )
    assert sorted(rows(profile.distinct_values(df, "y")), key=str) == [("a",), ("b",), (None,)]


# --- geometry --------------------------------------------------------------


def _brute_dissolve(data):
    lines = defaultdict(set)
    for key, parts in data:
        for part in parts:
            forward = tuple(map(tuple, part))
            lines[key].add(min(forward, forward[::-1]))
    return lines


def test_dissolve_equals_brute_force(spark):
    random.seed(3)
    pool = [
        [[float(random.randint(0, 3)), float(random.randint(0, 3))] for _ in range(2)]
        for _ in range(12)
    ]
    data = [
        (random.choice(["101", "116", "hot", "hot", "hot"]), random.choices(pool, k=3))
        for _ in range(60)
    ]
    data.append(("101", [pool[0][::-1]]))
    df = spark.createDataFrame(
        [*data, (None, [pool[0]])], "vl_br string, parts array<array<array<double>>>"
    )
    got = defaultdict(set)
    for row in geo.dissolve_parts(df, "vl_br").collect():
        part = tuple(map(tuple, row.part))
        assert part not in got[row.vl_br]
        got[row.vl_br].add(part)
    assert got == _brute_dissolve(data)


def test_a_key_without_lines_stays(spark):
    df = spark.createDataFrame([("101", [])], "k string, parts array<array<array<double>>>")
    assert rows(geo.dissolve_parts(df, "k")) == [("101", None)]


def test_with_position(spark):
    values = [None, 3, 1, 3, None, 2] * 50 + [7]
    df = spark.createDataFrame([(v, str(i)) for i, v in enumerate(values)], "v int, _tie string")
    got = rows(ranking.with_position(df.repartition(5), [F.desc_nulls_last("v"), "_tie"]))
    expected = sorted(enumerate(values), key=lambda e: (e[1] is None, -(e[1] or 0), str(e[0])))
    assert sorted(got, key=lambda r: r[2]) == [(v, str(i), n) for n, (i, v) in enumerate(expected, 1)]
    # Without a difference in the order every place is given once; no rows stay none.
    same = spark.range(1000).select(F.lit(1).alias("position"))
    placed = ranking.with_position(same, ["position"])
    assert placed.columns == ["position"]
    assert sorted(r[0] for r in placed.collect()) == list(range(1, 1001))
    assert rows(ranking.with_position(df.limit(0), ["v"])) == []


def test_a_long_selection_is_built_at_once_and_reaches_the_scan(spark, tmp_path):
    spark.range(4000).selectExpr("id", "cast(id AS string) AS t", "date_add(DATE'2000-01-01', cast(id AS int)) AS d").write.parquet(
        path := str(tmp_path / "t")
    )
    table = spark.read.parquet(path)
    start = time.perf_counter()
    chosen = filters.facet_filter(table, selections={"t": [str(i) for i in range(0, 6000, 2)], "id": list(range(0, 3000))})
    text = chosen._jdf.queryExecution().executedPlan().toString()
    assert time.perf_counter() - start < 3
    assert "In(t" in text and chosen.count() == 1500
    odd = ["it's", "back\\slash", "new\nline", "dou\"ble", "`tick`", "", "é", None]
    df = spark.createDataFrame([(x,) for x in [*odd, "other"]], "`a b` string")
    for value in odd:
        assert rows(filters.facet_filter(df, selections={"a b": [value]})) == [(value,)]
    assert len(rows(filters.facet_filter(df, selections={"a b": odd}))) == len(odd)
    days = [datetime.date(2000, 1, 2), "2000-01-03", "no day"]
    assert filters.facet_filter(table, selections={"d": days}).count() == 2
    assert filters.facet_filter(table, selections={"id": ["7", 8, 9.0, "x", None]}).count() == 3
