"""The registered queries: every operator over whole tables.

Dates come out as ISO text and ratios rounded to six places, so that results
can be compared with those of another engine.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from bronzeway import values as v
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
from bronzeway.plans import accidents, incremental, roles
from bronzeway.session import own_session, scratch_path
from bronzeway.sources import bronze, files, tables
from bronzeway.sources.geo import read_geojson, read_topojson_attributes, read_topojson_rings

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}

COUNT = v.GOLD_COUNT


def query(make: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return make(own_session(spark), sf_dir)

    QUERIES[make.__name__] = run
    return run


def _silver(spark, sf, *columns):
    return roles.frame(spark, sf, roles.SILVER, columns or None)


def _gold(spark, sf, *columns):
    return roles.frame(spark, sf, roles.GOLD, columns or None)


def _raw(spark, sf, *columns):
    return roles.frame(spark, sf, roles.RAW, columns or None)


def _orders(spark, sf):
    return roles.table(spark, sf, "orders")


def _iso(df: DataFrame, *dates: str) -> DataFrame:
    return df.withColumns({d: F.col(d).cast("string") for d in dates})


def _rounded(df: DataFrame, *cols: str) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c), 6) for c in cols})


# --- gold layer ------------------------------------------------------------


@query
def gold_rollup(spark, sf):
    return _iso(accidents.to_gold(_silver(spark, sf)), "DATA")


@query
def gold_store(spark, sf):
    """Written with clustering and read back by its URI."""
    path = scratch_path(spark, "gold")
    gold = accidents.to_gold(_silver(spark, sf))
    tables.write_table(gold, path, cluster_by=["DATA"])
    return _iso(tables.read_table(spark, path), "DATA")


@query
def yearly_totals(spark, sf):
    orders = _orders(spark, sf).select(
        F.to_date("o_orderdate").alias("DATA"),
        F.lit(1).alias("one"),
        F.round("o_totalprice").cast("bigint").alias("QT_PRECO"),
    )
    return rollup.yearly_totals(
        orders, "DATA", {"QT_PEDIDOS_ANO": "one", "QT_PRECO_ANO": "QT_PRECO"}
    )


@query
def yearly_check(spark, sf):
    return accidents.yearly_check(accidents.to_gold(_silver(spark, sf)))


# --- cleaning --------------------------------------------------------------


@query
def null_token_clean(spark, sf):
    rows = _raw(spark, sf, "id", "uf", "tipo_pista", "uso_solo")
    return clean.replace_null_tokens(rows, ["uf", "tipo_pista", "uso_solo"])


@query
def default_token_fill(spark, sf):
    rows = _raw(spark, sf, "id", "classificacao_acidente", "tracado_via")
    rows = clean.replace_null_tokens(rows, "classificacao_acidente", v.CLASSIFICATION_FILL)
    return clean.replace_null_tokens(rows, "tracado_via", v.LAYOUT_FILL)


@query
def lower_strip_suffix(spark, sf):
    rows = _raw(spark, sf, "id", "dia_semana", "fase_dia")
    return clean.strip_lowered(
        clean.lowercase(rows, "fase_dia"), "dia_semana", v.WEEKDAY_SUFFIX
    )


@query
def multi_format_date(spark, sf):
    rows = roles.table(spark, sf, "events").selectExpr(
        "event_id",
        "CASE cast(event_id % 4 AS int)"
        f" WHEN 0 THEN {roles.day_text('ts', 'iso')}"
        f" WHEN 1 THEN {roles.day_text('ts', 'dmy', short_year=True)}"
        f" WHEN 2 THEN {roles.day_text('ts', 'dmy')} ELSE '31/02/2010' END AS day",
    )
    parsed = clean.parse_date_multi(rows, "day", v.DATE_SHAPES, v.DATE_OTHERWISE)
    return _iso(parsed, "day")


@query
def decimal_comma(spark, sf):
    rows = clean.replace_null_tokens(
        _raw(spark, sf, "id", *v.FLOAT_COLUMNS), v.FLOAT_COLUMNS
    )
    return clean.parse_decimal_comma(rows, v.FLOAT_COLUMNS)


@query
def safe_int(spark, sf):
    rows = clean.replace_null_tokens(
        _raw(spark, sf, "id", *v.COUNT_COLUMNS), v.COUNT_COLUMNS
    )
    return clean.parse_int(rows, v.COUNT_COLUMNS)


@query
def zero_pad(spark, sf):
    rows = clean.replace_null_tokens(_raw(spark, sf, "id", "br"), "br")
    return clean.zero_pad_code(rows, "br", v.HIGHWAY_WIDTH, "null")


@query
def recode_map(spark, sf):
    brands = {
        f"Brand#{i}": f"Grupo {i % 4}" for i in range(1, 21) if i % 5
    }
    parts = roles.table(spark, sf, "part").select("p_partkey", "p_brand")
    return clean.recode(parts, "p_brand", brands, to_null=["Brand#25"])


@query
def recode_join(spark, sf):
    """The same kind of recode with the mapping in a table."""
    mapping = roles.table(spark, sf, "part").select(
        F.col("p_partkey").cast("string").alias("old"), F.col("p_brand").alias("new")
    ).filter("p_partkey % 3 <> 0")
    rows = roles.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", F.col("l_partkey").cast("string").alias("code")
    )
    return clean.recode(rows, "code", mapping)


@query
def contains_recode(spark, sf):
    rules = [
        ("contains", ["red", "widget"], "red thing"),
        ("contains", ["small"], "small thing"),
        ("swap", "bolt", "screw"),
        ("equals", "hot gear", "gear"),
    ]
    parts = roles.table(spark, sf, "part").select("p_partkey", "p_name")
    return clean.recode_rules(parts, "p_name", rules)


@query
def partial_recode(spark, sf):
    parts = roles.table(spark, sf, "part").select("p_partkey", "p_type")
    return clean.recode(
        parts, "p_type", {"SMALL": "pequeno", "LARGE": "grande"}, otherwise="null"
    )


@query
def silver_clean(spark, sf):
    return _iso(accidents.to_silver(_raw(spark, sf)), "date")


@query
def silver_clean_strict(spark, sf):
    silver = accidents.to_silver(_raw(spark, sf), accidents.CLEAN)
    return silver.select("id", "br", "condicao_metereologica", "causa_acidente")


@query
def rename_project(spark, sf):
    orders = schema.project(
        _orders(spark, sf), ["o_orderkey", "o_orderstatus", "o_orderpriority"]
    )
    return schema.rename(
        orders, {"o_orderkey": "id", "o_orderstatus": "DS_FASE", "o_orderpriority": "DS_TIPO"}
    )


# --- bronze layer ----------------------------------------------------------


def _order_slices(spark, sf):
    """Orders as two deliveries whose columns differ in number, order and case."""
    orders = _orders(spark, sf).withColumn("o_orderdate", F.to_date("o_orderdate"))
    # Rows without a date are late, so that each row is in one of the two.
    early = F.coalesce(F.year("o_orderdate") < 1998, F.lit(False))
    return {
        "early": orders.filter(early).select("o_orderkey", "o_custkey", "o_orderstatus"),
        "late": orders.filter(~early).select(
            "o_orderpriority", F.col("o_orderkey").alias("O_ORDERKEY"), "o_orderdate",
            "o_orderstatus",
        ),
    }


#: Delivered files are packed, so they don't split: this many rows of one are a task's share.
DELIVERED = {**v.CSV_OPTIONS, "compression": "gzip", "maxRecordsPerFile": "1000000"}
PACKED = "*.csv.gz"


def _deliver(spark, slices: dict[str, DataFrame]) -> str:
    """Slices as delimited files, each in a folder of its name."""
    folder = scratch_path(spark, "raw")
    for name, rows in slices.items():
        rows.write.options(**DELIVERED).csv(f"{folder}/{name}")
    return folder


def _deliver_files(spark, rows: DataFrame, folder: str, name: str) -> None:
    """Rows as files whose names stay, in place of what they held before.

    Every task writes its own files beside the folder, which are put in by their number.
    What was delivered under the name before and has no rows now is a header.
    """
    hadoop = spark._jvm.org.apache.hadoop.fs
    conf = spark._jsc.hadoopConfiguration()
    system = hadoop.Path(folder).getFileSystem(conf)
    system.mkdirs(hadoop.Path(folder))

    def write(rows: DataFrame) -> list:
        aside = scratch_path(spark, "delivery")
        rows.write.options(**DELIVERED).csv(aside)
        # In the order of their names, which is that of the tasks.
        return [f.getPath() for f in system.globStatus(hadoop.Path(f"{aside}/part-*"))]

    def target(i: int):
        return hadoop.Path(f"{folder}/{name}-{i:05}.csv.gz")

    written = write(rows)
    for i, path in enumerate(written):
        system.delete(target(i), False)
        system.rename(path, target(i))
    before = len(system.globStatus(hadoop.Path(f"{folder}/{name}-*.csv.gz")))
    header = write(rows.limit(0))[0] if before > len(written) else None
    for i in range(len(written), before):
        hadoop.FileUtil.copy(system, header, system, target(i), False, True, conf)


def _delivered(spark, folder: str) -> list[str]:
    return [r.path for r in files.list_source_files(spark, folder, PACKED, recursive=True).collect()]


def _delivery_name():
    return F.regexp_extract(v.SOURCE_COLUMN, r"/([^/]+)/[^/]+$", 1)


@query
def schema_drift_union(spark, sf):
    slices = _order_slices(spark, sf)
    return _iso(schema.union_drifting(list(slices.values())), "o_orderdate")


@query
def bronze_append(spark, sf):
    """Create, then append rows that bring a new column."""
    path = scratch_path(spark, "bronze")
    for position, (name, rows) in enumerate(_order_slices(spark, sf).items()):
        rows = rows.toDF(*(c.lower() for c in rows.columns)).withColumn(
            v.SOURCE_COLUMN, F.lit(name)
        )
        if position == 0:
            bronze.write_bronze(rows, path)
        else:
            bronze.append_bronze(rows, path)
    return _iso(bronze.read_bronze(spark, path), "o_orderdate")


@query
def bronze_csv_roundtrip(spark, sf):
    folder = _deliver(spark, {"all": _iso(_orders(spark, sf), "o_orderdate")})
    path = scratch_path(spark, "bronze")
    raw = files.with_source_file(files.read_raw_csv(spark, _delivered(spark, folder)))
    bronze.write_bronze(raw, path)
    return bronze.read_bronze(spark, path).select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority"
    )


@query
def incremental_idempotent(spark, sf):
    """The early files, then all files, then all files again."""
    folder = _deliver(spark, _order_slices(spark, sf))
    path = scratch_path(spark, "bronze")
    paths = _delivered(spark, folder)
    for batch in ([p for p in paths if "/early/" in p], paths, paths):
        bronze.ingest_files(spark, batch, path)
    return bronze.read_bronze(spark, path).drop(v.SOURCE_COLUMN)


@query
def incremental_new_files(spark, sf):
    """Only files that are not in the table yet are loaded."""
    slices = _order_slices(spark, sf)
    folder = _deliver(spark, slices)
    path = scratch_path(spark, "bronze")
    bronze.ingest_files(spark, _delivered(spark, f"{folder}/early"), path)
    bronze.ingest_files(spark, bronze.pending_files(spark, folder, path, True, glob=PACKED), path)
    return bronze.read_bronze(spark, path).drop(v.SOURCE_COLUMN)


@query
def incremental_replaced(spark, sf):
    """One source comes again with fewer rows, one with none, and one stays."""
    path = scratch_path(spark, "bronze")
    slices = _order_slices(spark, sf)
    named = {n: r.withColumn(v.SOURCE_COLUMN, F.lit(n)) for n, r in slices.items()}
    named["kept"] = named["early"].withColumn(v.SOURCE_COLUMN, F.lit("kept"))
    for rows in named.values():
        bronze.replace_sources(spark, rows, [], path)
    fewer = named["early"].filter("o_orderkey % 3 = 0")
    bronze.replace_sources(spark, fewer, ["late"], path)
    columns = ["o_orderkey", "o_orderstatus"]
    return bronze.read_bronze(spark, path).select(*columns, v.SOURCE_COLUMN)


@query
def incremental_changed(spark, sf):
    """Files that come again under their names: with other rows, none, the same; one is new."""
    orders = _orders(spark, sf).withColumn("o_orderdate", F.to_date("o_orderdate").cast("string"))
    rows = orders.select("o_orderkey", "o_orderstatus", "o_orderdate")
    folder, path = scratch_path(spark, "raw"), scratch_path(spark, "bronze")
    by_year = F.coalesce(F.substring("o_orderdate", 1, 4).cast("int"), F.lit(0))
    for name, slice_ in (("changed", by_year < 1997), ("emptied", by_year == 1997), ("same", by_year > 1998)):
        _deliver_files(spark, rows.filter(slice_), folder, name)
    bronze.ingest_files(spark, bronze.pending_files(spark, folder, path, glob=PACKED), path)
    other = rows.filter(by_year < 1997).withColumn("o_orderstatus", F.lower("o_orderstatus"))
    _deliver_files(spark, other, folder, "changed")
    _deliver_files(spark, rows.limit(0), folder, "emptied")
    _deliver_files(spark, rows.filter(by_year > 1998), folder, "same")
    _deliver_files(spark, rows.filter(by_year == 1998), folder, "new")
    pending = bronze.pending_files(spark, folder, path, glob=PACKED)
    names = sorted({p.rsplit("/", 1)[1].split("-")[0] for p in pending})
    bronze.ingest_files(spark, pending, path)
    return bronze.read_bronze(spark, path).drop(v.SOURCE_COLUMN).withColumn(
        "pending", F.lit(" ".join(names))
    )


@query
def odd_headers(spark, sf):
    """Files with a blank and a repeated name in their header, and one with a line break."""
    orders = _orders(spark, sf).withColumn("o_orderdate", F.to_date("o_orderdate").cast("string"))
    folder = _deliver(
        spark,
        {
            "odd": orders.select("o_orderkey", F.col("o_orderstatus").alias("code"),
                                 F.col("o_orderpriority").alias(" ")),
            "twice": orders.select("o_orderkey", F.col("o_orderstatus").alias("code"),
                                   F.col("o_orderdate").alias("Code")),
            "broken": orders.select("o_orderkey", F.col("o_orderstatus").alias("order\nstatus")),
        },
    )
    rows = files.read_drifting_csv(spark, _delivered(spark, folder))
    return rows.select(
        "o_orderkey", "code", "_c2", "code1", "code2", F.col("order\nstatus").alias("status")
    )


@query
def provenance_counts(spark, sf):
    folder = _deliver(spark, _order_slices(spark, sf))
    rows = files.read_drifting_csv(spark, _delivered(spark, folder))
    return rows.groupBy(_delivery_name().alias("delivery")).agg(F.count("*").alias("n_rows"))


@query
def common_columns(spark, sf):
    """Columns of every delivered file, with the rows that fill them."""
    folder = _deliver(spark, _order_slices(spark, sf))
    paths = _delivered(spark, folder)
    common = schema.common_columns(spark, files.read_headers(spark, paths))
    raw = files.read_drifting_csv(spark, paths).drop(v.SOURCE_COLUMN)
    filled = raw.select(*(F.count(c).alias(c) for c in raw.columns)).unpivot(
        [], raw.columns, "column", "n_filled"
    )
    return filled.join(common, "column", "left_semi")


@query
def described_columns(spark, sf):
    """Position, type and filled rows of each column of the delivered rows."""
    rows = schema.union_drifting(list(_order_slices(spark, sf).values()))
    filled = rows.select(*(F.count(c).alias(c) for c in rows.columns)).unpivot(
        [], rows.columns, "column", "n_filled"
    )
    return schema.describe_schema(rows).join(filled, "column")


def _raw_slices(spark, sf) -> Callable[[int], DataFrame]:
    """Raw rows of slice 1, 2 or 3: their rows are told apart before the text is made."""
    split = "CASE WHEN year(l_shipdate) < 1998 THEN 1 WHEN year(l_shipdate) < 2000 THEN 2 ELSE 3 END"
    made = roles.frame(spark, sf, {**roles.RAW, "_slice": split})
    return lambda number: made.filter(F.col("_slice") == number).drop("_slice")


@query
def medallion_gold(spark, sf):
    """Drifting source files to bronze, silver and gold, each layer stored."""
    slice_of = _raw_slices(spark, sf)
    lean = [c for c in v.RAW_COLUMNS if c not in v.RAW_COLUMNS[-5:]]
    turned = [F.col(c).alias("UOP" if c == "uop" else c) for c in reversed(v.RAW_COLUMNS)]
    folder = _deliver(
        spark,
        {
            "first": slice_of(1).select(*lean),
            "second": slice_of(2).select(*v.RAW_COLUMNS),
            "third": slice_of(3).select(*turned),
        },
    )
    lake = scratch_path(spark, "lake")
    bronze.ingest_files(spark, _delivered(spark, folder), f"{lake}/bronze")
    rows = bronze.read_bronze(spark, f"{lake}/bronze", columns=v.SILVER_SOURCE_COLUMNS)
    tables.write_table(accidents.to_silver(rows), f"{lake}/silver")
    gold = accidents.to_gold(tables.read_table(spark, f"{lake}/silver"))
    tables.write_table(gold, f"{lake}/gold", cluster_by=["DATA"])
    return _iso(tables.read_table(spark, f"{lake}/gold"), "DATA")


def _changing_lake(spark, sf) -> str:
    """A lake after three runs: a source is added, one comes with fewer rows, one with none."""
    slice_of = _raw_slices(spark, sf)
    folder, lake = scratch_path(spark, "raw"), scratch_path(spark, "lake")

    def deliver(name: str, number: int, rows: str = "true") -> None:
        _deliver_files(spark, slice_of(number).filter(rows), folder, name)

    deliver("first", 1)
    deliver("second", 2)
    incremental.refresh(spark, folder, lake, glob=PACKED)
    deliver("second", 2, "right(id, 1) IN ('1', '2')")
    deliver("third", 3)
    incremental.refresh(spark, folder, lake, glob=PACKED)
    deliver("first", 1, "false")
    incremental.refresh(spark, folder, lake, glob=PACKED)
    return lake


@query
def gold_incremental(spark, sf):
    """Gold kept up to date, source by source."""
    return _iso(incremental.read_gold(spark, _changing_lake(spark, sf)), "DATA")


@query
def layers_reconciled(spark, sf):
    """What each layer was written with, run by run, against the rows of bronze."""
    return incremental.reconciled(spark, _changing_lake(spark, sf))


# --- profiles --------------------------------------------------------------


@query
def profile_number_formats(spark, sf):
    return accidents.format_profile(
        _raw(spark, sf, *v.FORMAT_PROFILE_COLUMNS)
    )


@query
def profile_distinct(spark, sf):
    return accidents.value_profile(_raw(spark, sf, *v.VALUE_PROFILE_COLUMNS))


@query
def profile_first_values(spark, sf):
    """The first rows per column, as a reader is shown them."""
    rows = roles.table(spark, sf, "lineitem")
    return profile.profile_values(
        rows, ["l_returnflag", "l_partkey", "l_suppkey"], v.PROFILE_ROWS
    )


@query
def distinct_values(spark, sf):
    return profile.distinct_values(_orders(spark, sf), "o_orderpriority")


@query
def peek_rows(spark, sf):
    return schema.peek(
        _orders(spark, sf).select("o_orderkey", "o_orderstatus"), 200, ["o_orderkey"]
    )


@query
def sample_rows(spark, sf):
    orders = _orders(spark, sf).select("o_orderkey", "o_custkey")
    return schema.sample_rows(orders, v.SAMPLE_FRACTION, v.SAMPLE_SEED, key="o_orderkey")


@query
def sample_bernoulli(spark, sf):
    """The engine's own sample, which rows depend on the partitions: what must hold.

    No row from outside of the table, none twice, and about the share asked for.
    """
    orders = _orders(spark, sf).select("o_orderkey")
    taken = schema.sample_rows(orders, v.SAMPLE_FRACTION, v.SAMPLE_SEED)
    marked = orders.withColumn("n", F.lit(0)).union(taken.withColumn("n", F.lit(1)))
    per_row = marked.groupBy("o_orderkey").agg(F.count("*").alias("seen"), F.sum("n").alias("n"))
    share = F.sum("n") / F.count("*")
    return per_row.agg(
        F.count_if(F.col("seen") == F.col("n")).alias("outside"),
        F.count_if(F.col("n") > 1).alias("repeated"),
        (F.abs(share - v.SAMPLE_FRACTION) < 0.03).alias("share_ok"),
    )


@query
def sample_blocks_bronze(spark, sf):
    """A sample of a bronze table from some of its files: what must hold.

    No row from outside of the table, none twice, about the share of the files, all rows
    of one weight, and about as many rows as the weights say.
    """
    path = scratch_path(spark, "bronze")
    orders = _orders(spark, sf).select("o_orderkey", "o_orderstatus")
    for name, rest in (("even", 0), ("odd", 1)):
        part = orders.filter(F.col("o_orderkey") % 2 == rest).withColumn(v.SOURCE_COLUMN, F.lit(name))
        bronze.append_bronze(part.repartition(40, "o_orderkey"), path)
    table = bronze.read_bronze(spark, path)
    fraction = 4 * v.SAMPLE_FRACTION
    taken = bronze.sample_bronze(spark, path, fraction, v.SAMPLE_SEED)
    n_files = table.select(F.count_distinct(F.col("_metadata.file_name"))).first()[0]
    used = taken.select(F.col("o_orderkey"), "weight").withColumn("n", F.lit(1))
    marked = table.select("o_orderkey", F.lit(0.0).alias("weight"), F.lit(0).alias("n")).union(
        used.select("o_orderkey", "weight", "n")
    )
    per_row = marked.groupBy("o_orderkey").agg(
        F.count("*").alias("seen"), F.sum("n").alias("n"), F.sum("weight").alias("weight")
    )
    read = taken.select(F.count_distinct(F.col("_metadata.file_name"))).first()[0]
    return per_row.agg(
        F.count_if(F.col("seen") == F.col("n")).alias("outside"),
        F.count_if(F.col("n") > 1).alias("repeated"),
        (F.abs(F.sum("n") / F.count("*") - fraction) < 0.08).alias("share_ok"),
        (F.abs(F.sum("weight") / F.count("*") - 1) < 0.4).alias("weights_ok"),
        F.lit(read <= 2 * fraction * n_files + 1).alias("files_ok"),
    )


@query
def rate_edges(spark, sf):
    """More groups than are shown; some with deaths over nobody, some without either."""
    rows = roles.table(spark, sf, "lineitem").select(
        F.concat(F.lit("T"), (F.col("l_partkey") % 14).cast("string")).alias("DS_TIPO"),
        F.when(F.col("l_partkey") % 14 == 5, 0)
        .otherwise(F.col("l_linenumber") % 3)
        .cast("bigint")
        .alias("QT_TOTAL_MORTOS"),
        F.when(F.col("l_partkey") % 14 < 6, F.when(F.col("l_partkey") % 14 > 2, 0))
        .otherwise(F.col("l_quantity"))
        .cast("bigint")
        .alias("QT_TOTAL_PESSOAS"),
    )
    rates = rollup.rate_by(rows, "DS_TIPO", "QT_TOTAL_MORTOS", "QT_TOTAL_PESSOAS", "rate")
    top = ranking.top_table(rates, "DS_TIPO", "rate", v.TOP_RATES)
    return top.select("DS_TIPO", F.round("rate", 6).alias("rate"))


@query
def facet_filter_typed(spark, sf):
    """Selections of a number and a date column, given as text, one value being neither."""
    rows = _orders(spark, sf).select(
        "o_orderkey", F.to_date("o_orderdate").alias("day"), "o_custkey"
    )
    customers = [str(i) for i in range(0, 2400, 2)] + ["none"]
    days = [f"{year}-{month:02}-{day:02}" for year in range(1995, 2002)
            for month in range(1, 13) for day in range(1, 29, 2)]
    chosen = filters.facet_filter(rows, selections={"o_custkey": customers, "day": days})
    return _iso(chosen, "day")


# --- reports ---------------------------------------------------------------


@query
def filter_facets(spark, sf):
    return accidents.choices(_gold(spark, sf, "DS_TIPO", "SG_UF", "DS_BR"))


@query
def filter_years(spark, sf):
    return filters.year_bounds(_gold(spark, sf, "DATA"), "DATA")


@query
def facet_filter(spark, sf):
    """Years, two selected types, states with the missing one, all highways."""
    rows = accidents.selection(
        _gold(spark, sf),
        years=(1996, 1999),
        types=["1-URGENT", "5-LOW"],
        states=[f"NATION_{i}" for i in range(12)] + [None],
    )
    return _iso(rows, "DATA")


@query
def facet_filter_many(spark, sf):
    """A selection too long for a literal list."""
    rows = _gold(spark, sf, "DS_BR", COUNT)
    chosen = [str(i) for i in range(0, 3000, 2)]
    return filters.facet_filter(rows, selections={"DS_BR": chosen})


@query
def kpi_cards(spark, sf):
    return accidents.cards(_gold(spark, sf, *v.CARD_MEASURES))


@query
def dim_join_counts(spark, sf):
    nation = roles.table(spark, sf, "nation")
    return joins.aggregate_and_join(
        _gold(spark, sf, "SG_UF", COUNT), nation, COUNT, "SG_UF", "n_name"
    )


@query
def dim_join_having(spark, sf):
    suppliers = roles.table(spark, sf, "supplier").select(
        F.col("s_suppkey").cast("string").alias(v.HIGHWAY_DIM_KEY), "s_name"
    )
    return accidents.by_highway(_gold(spark, sf, "DS_BR", COUNT), suppliers)


@query
def top15_by_count(spark, sf):
    sums = rollup.sum_by(_gold(spark, sf, "DS_CAUSA", COUNT), [COUNT], ["DS_CAUSA"])
    return ranking.top_table(sums, "DS_CAUSA", COUNT, value_alias="QTD")


@query
def share_topn_others(spark, sf):
    return _rounded(accidents.causes(_gold(spark, sf, "DS_CAUSA", COUNT)), "PERCENTUAL")


@query
def share_of_total(spark, sf):
    sums = rollup.sum_by(_gold(spark, sf, "DS_BR", COUNT), [COUNT], ["DS_BR"])
    return _rounded(ranking.share_of_total(sums, COUNT), "PERCENTUAL")


@query
def position_all(spark, sf):
    """The place of every order, largest price first, beside its share of all prices."""
    orders = _orders(spark, sf).select(
        "o_orderkey", F.round("o_totalprice").cast("bigint").alias("QT_PRECO")
    )
    shares = ranking.share_of_total(orders, "QT_PRECO")
    return _rounded(
        ranking.with_position(shares, [F.desc_nulls_last("QT_PRECO"), "o_orderkey"]), "PERCENTUAL"
    )


@query
def rate_top10(spark, sf):
    rows = _gold(spark, sf, "DS_TIPO", "QT_TOTAL_MORTOS", "QT_TOTAL_PESSOAS")
    return _rounded(accidents.death_rates(rows), "TAXA_LETALIDADE")


@query
def year_bars(spark, sf):
    return accidents.accidents_by_year(_gold(spark, sf, "DATA", COUNT))


@query
def class_breaks(spark, sf):
    sums = rollup.sum_by(_gold(spark, sf, "SG_UF", COUNT), [COUNT], ["SG_UF"])
    return _rounded(ranking.class_breaks(sums, COUNT), "value")


@query
def equal_width_classes(spark, sf):
    sums = rollup.sum_by(_gold(spark, sf, "SG_UF", COUNT), [COUNT], ["SG_UF"])
    return accidents.map_classes(sums)


@query
def minmax_scale(spark, sf):
    sums = rollup.sum_by(_gold(spark, sf, "DS_CAUSA", COUNT), [COUNT], ["DS_CAUSA"])
    return _rounded(ranking.minmax_scale(ranking.top_table(sums, "DS_CAUSA", COUNT), COUNT), "scaled")


@query
def highway_panel(spark, sf):
    """Join, more than 1000 accidents, 15 largest, shades of the rows shown."""
    suppliers = roles.table(spark, sf, "supplier").select(
        F.col("s_suppkey").cast("string").alias(v.HIGHWAY_DIM_KEY)
    )
    counts = accidents.by_highway(_gold(spark, sf, "DS_BR", COUNT), suppliers)
    table = accidents.count_table(counts, "DS_BR", v.TABLE_CLASSES_HIGHWAY)
    return table.withColumnRenamed(v.COUNT_LABEL, "QTD")


@query
def state_panel(spark, sf):
    nation = roles.table(spark, sf, "nation").select(F.col("n_name").alias(v.STATE_DIM_KEY))
    counts = accidents.by_state(_gold(spark, sf, "SG_UF", COUNT), nation)
    table = accidents.count_table(counts, "SG_UF", v.TABLE_CLASSES_STATE)
    return table.withColumnRenamed(v.COUNT_LABEL, "QTD")


@query
def map_legend(spark, sf):
    nation = roles.table(spark, sf, "nation").select(F.col("n_name").alias(v.STATE_DIM_KEY))
    counts = accidents.by_state(_gold(spark, sf, "SG_UF", COUNT), nation)
    return accidents.map_legend(counts, "mil").select("position", "label")


@query
def label_truncate(spark, sf):
    documents = roles.table(spark, sf, "documents").select("doc_id", "text", "source")
    return clean.truncate_label(documents, "text", v.LABEL_WIDTH)


@query
def display_numbers(spark, sf):
    sums = rollup.sum_by(_gold(spark, sf, "SG_UF", COUNT), [COUNT], ["SG_UF"])
    for style in ("grouped", "mil", "mil_round", "k1"):
        sums = clean.display_number(sums, COUNT, style, style)
    return sums


@query
def selected_panels(spark, sf):
    """Two panels over one cached selection, stored for the reader."""
    path = scratch_path(spark, "panels")
    rows = accidents.selection(
        _gold(spark, sf, "DATA", "SG_UF", "DS_CAUSA", COUNT), years=(1996, 1999)
    )
    with tables.cached(rows) as kept:
        for panel, key in (("SG_UF", "SG_UF"), ("DS_CAUSA", "DS_CAUSA")):
            sums = rollup.sum_by(kept, [COUNT], [key])
            tables.write_table(
                sums.select(F.lit(panel).alias("panel"), F.col(key).alias("label"), COUNT),
                path,
                mode="append",
            )
    return tables.read_table(spark, path)


@query
def report_panels(spark, sf):
    """Every panel of one selection, as text."""
    suppliers = roles.table(spark, sf, "supplier").select(
        F.col("s_suppkey").cast("string").alias(v.HIGHWAY_DIM_KEY)
    )
    nation = roles.table(spark, sf, "nation").select(F.col("n_name").alias(v.STATE_DIM_KEY))
    return accidents.report(
        _gold(spark, sf), suppliers, nation, years=(1996, 1999), types=["1-URGENT", "5-LOW", "2-HIGH"]
    )


@query
def report_kept(spark, sf):
    """A report asked for twice, the second time with its values in another order."""
    suppliers = roles.table(spark, sf, "supplier").select(
        F.col("s_suppkey").cast("string").alias(v.HIGHWAY_DIM_KEY)
    )
    nation = roles.table(spark, sf, "nation").select(F.col("n_name").alias(v.STATE_DIM_KEY))
    lake, store = scratch_path(spark, "lake"), scratch_path(spark, "kept")
    tables.publish_table(_gold(spark, sf), f"{lake}/gold", cluster_by=["DATA"])
    types = ["1-URGENT", "5-LOW", "2-HIGH"]
    for listed in (types, types[::-1]):
        shown = incremental.kept_report(
            spark, lake, store, suppliers, nation, years=(1996, 1999), types=listed
        )
    return shown


# --- geometry --------------------------------------------------------------


def _dissolved(lines: DataFrame, key: str, numbers) -> DataFrame:
    """Lines, numbers and a digest of all coordinates of each key.

    ``numbers`` gives the numbers of a line in order.
    """
    places = F.transform(
        numbers(F.col("part")), lambda x, i: (i + 1) * F.round(x * 1000).cast("bigint")
    )
    return (
        geo.dissolve_parts(lines, key)
        .select(key, F.size(numbers(F.col("part"))).alias("n"), F.aggregate(
            places, F.lit(0).cast("bigint"), lambda total, x: total + x).alias("digest"))
        .groupBy(key)
        .agg(
            F.count("*").alias("n_parts"),
            F.sum("n").alias("n_numbers"),
            F.sum("digest").alias("digest"),
        )
    )


@query
def geo_dissolve(spark, sf):
    """Each vector is a line and comes twice, once from its other end."""
    rows = roles.table(spark, sf, "embeddings").select(
        "label", F.col("embedding").cast("array<double>").alias("line")
    )
    both = rows.select("label", F.array("line", F.reverse("line")).alias("parts"))
    return _dissolved(both, "label", lambda part: part)


def _pairs(numbers):
    """Pairs of neighbouring numbers, as points."""
    return F.transform(
        F.sequence(F.lit(0), F.size(numbers) - 2, F.lit(2)),
        lambda i: F.slice(numbers, i + 1, 2).cast("array<double>"),
    )


@query
def geojson_lines(spark, sf):
    """Vectors written as line features, twice each, read back and dissolved."""
    path = scratch_path(spark, "geojson")
    line = _pairs(F.col("embedding"))
    turned = F.explode(F.array(line, F.reverse(line)))
    roles.table(spark, sf, "embeddings").select("label", turned.alias("line")).select(
        F.lit("Feature").alias("type"),
        F.struct(F.col("label").alias(v.HIGHWAY_DIM_KEY)).alias("properties"),
        F.struct(F.lit("LineString").alias("type"), F.col("line").alias("coordinates")).alias(
            "geometry"
        ),
    ).write.json(path)
    lines = read_geojson(spark, path, by_line=True)
    return _dissolved(lines, v.HIGHWAY_DIM_KEY, F.flatten).withColumn(
        v.HIGHWAY_DIM_KEY, F.col(v.HIGHWAY_DIM_KEY).cast("int")
    )


@query
def geojson_collections(spark, sf):
    """Feature collections, a file for every hundred suppliers.

    Lines and pairs of lines, every third supplier twice; a line is the key's
    digits, so what is read can be told from it.
    """
    path = scratch_path(spark, "collections")
    key = F.col("s_suppkey")
    line = F.array(
        F.array(key.cast("double"), F.lit(0.5)), F.array((key % 7).cast("double"), F.lit(2.0))
    )
    second = F.array(F.array(F.lit(1.0), key.cast("double")), F.array(F.lit(3.0), F.lit(4.0)))
    geometry = F.when(
        key % 2 == 0,
        F.to_json(F.struct(F.lit("LineString").alias("type"), line.alias("coordinates"))),
    ).otherwise(
        F.to_json(
            F.struct(
                F.lit("MultiLineString").alias("type"), F.array(line, second).alias("coordinates")
            )
        )
    )
    feature = F.concat(
        F.lit('{"type":"Feature","properties":{"vl_br":"'), (key % 5).cast("string"),
        F.lit('"},"geometry":'), geometry, F.lit("}"),
    )
    copies = F.sequence(F.lit(1), F.when(key % 3 == 0, 2).otherwise(1))
    files_of = (
        roles.table(spark, sf, "supplier")
        .select(feature.alias("feature"), F.floor(key / 100).alias("file"), F.explode(copies))
        .groupBy("file")
        .agg(F.array_join(F.collect_list("feature"), ",").alias("features"))
        .select(
            "file",
            F.concat(
                F.lit('{"type":"FeatureCollection","features":['), "features", F.lit("]}")
            ).alias("value"),
        )
    )
    files_of.write.partitionBy("file").text(path)
    # A file is cut into splits of 4 KB, most of them amid a feature.
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    kind = StructType([StructField(v.HIGHWAY_DIM_KEY, StringType())])
    lines = read_geojson(spark, path, properties=kind)
    return _dissolved(lines, v.HIGHWAY_DIM_KEY, F.flatten)


@query
def topojson_join(spark, sf):
    """Nations written as a topology, read back and joined to counts of suppliers."""
    path = scratch_path(spark, "topology")
    geometries = roles.table(spark, sf, "nation").select(
        F.lit(1).alias("one"),
        F.to_json(
            F.struct(
                F.col("n_nationkey").cast("string").alias("id"),
                F.lit("Polygon").alias("type"),
                F.struct(F.col("n_name").alias("name")).alias("properties"),
            )
        ).alias("g"),
    )
    # A dimension of 25 rows, and by format one document.
    geometries.groupBy("one").agg(F.array_join(F.collect_list("g"), ",").alias("g")).select(
        F.concat(
            F.lit('{"type":"Topology","objects":{"states":{"type":"GeometryCollection","geometries":['),
            "g",
            F.lit("]}},\"arcs\":[]}"),
        ).alias("value")
    ).write.text(path)
    states = read_topojson_attributes(spark, path)
    suppliers = roles.table(spark, sf, "supplier").select(
        F.col("s_nationkey").cast("string").alias("SG_UF"), F.lit(1).alias(COUNT)
    )
    return accidents.by_state(suppliers, states)


@query
def topojson_rings(spark, sf):
    """Nations as cells of a grid, their borders stored once, read back as rings.

    Every fifth nation has a second cell, far away. A border is an arc of two steps on a
    grid; cells above and to the left of it take it the other way round.
    """
    path = scratch_path(spark, "rings")
    nations = roles.table(spark, sf, "nation").select(
        F.col("n_nationkey").cast("int").alias("k"), F.col("n_name").alias("name")
    )
    cells = nations.select(
        "k", "name", F.explode(F.when(F.col("k") % 5 == 4, F.array("k", F.col("k") + 100)).otherwise(F.array("k"))).alias("cell")
    ).select("k", "name", "cell", (F.col("cell") % 5).alias("c"), F.floor(F.col("cell") / 5).cast("int").alias("r"))
    # The border below a cell is arc 2 * number, the one to its left the arc behind it; the
    # number of a place is 6 * row + column, as a row of cells has one more border.
    at = lambda r, c: 2 * (6 * F.col("r") + F.col("c") + 6 * r + c)
    ring = F.array(at(0, 0), at(0, 1) + 1, -1 - at(1, 0), -1 - (at(0, 0) + 1))
    shapes = cells.groupBy("k", "name").agg(F.array_sort(F.collect_list(F.struct("cell", ring.alias("ring"))))["ring"].alias("rings"))
    one = F.size("rings") == 1
    geometry = F.struct(
        F.col("k").cast("string").alias("id"),
        F.struct("name").alias("properties"),
        F.when(one, "Polygon").otherwise("MultiPolygon").alias("type"),
        F.lit("@").alias("arcs"),
    )
    nested = F.when(one, F.to_json("rings")).otherwise(F.to_json(F.transform("rings", lambda x: F.array(x))))
    geometries = shapes.select(F.replace(F.to_json(geometry), F.lit('"@"'), nested).alias("g"))
    places = spark.range(6 * 27).select(F.floor(F.col("id") / 6).cast("int").alias("r"), (F.col("id") % 6).cast("int").alias("c"), "id")
    start, flat, up = F.array("c", "r"), F.array(F.lit(1), F.lit(0)), F.array(F.lit(0), F.lit(1))
    arcs = places.select("id", F.to_json(F.array(start, flat)).alias("below"), F.to_json(F.array(start, up)).alias("left"))
    # A dimension of 25 rows, and by format one document.
    arc_text = arcs.agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("id", "below", "left"))),
                                 lambda a: F.concat_ws(",", a["below"], a["left"])), ",").alias("arcs"))
    geometries.agg(F.array_join(F.collect_list("g"), ",").alias("g")).join(arc_text).select(
        F.concat(
            F.lit('{"type":"Topology","transform":{"scale":[0.5,0.25],"translate":[-70,-30]},'
                  '"objects":{"states":{"type":"GeometryCollection","geometries":['),
            "g", F.lit(']}},"arcs":['), "arcs", F.lit("]}"),
        ).alias("value")
    ).write.text(path)
    rings = read_topojson_rings(spark, path)
    total = lambda axis: F.aggregate("points", F.lit(0.0), lambda t, p: t + p[axis])
    after = F.slice("points", 2, F.size("points"))
    area = F.aggregate(
        F.zip_with(after, F.slice("points", 1, F.size("points") - 1), lambda b, a: a[0] * b[1] - b[0] * a[1]),
        F.lit(0.0), lambda t, x: t + x / 2,
    )
    return rings.groupBy("id", "name", "object").agg(
        F.count("*").cast("int").alias("n_rings"),
        F.sum(F.size("points")).cast("int").alias("n_points"),
        F.round(F.sum(area), 6).alias("area"),
        F.round(F.sum(total(0)), 6).alias("sum_x"),
        F.round(F.sum(total(1)), 6).alias("sum_y"),
        F.bool_and(F.get("points", F.lit(0)) == F.element_at("points", -1)).alias("closed"),
    )
