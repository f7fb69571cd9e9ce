"""The accident pipeline and its reports.

Each layer is a function from one frame to the next, so a job reads a layer,
applies the function and writes the next layer in a single action.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bronzeway import values as v
from bronzeway.functions.dates import date_by_shape
from bronzeway.functions.numbers import comma_float, lenient_int, padded_code
from bronzeway.functions.recode import by_rules, lookup
from bronzeway.functions.text import lower_without, null_token
from bronzeway.operators import filters, joins, profile, ranking, rollup, schema
from bronzeway.operators.clean import display_number, truncate_label, with_year
from bronzeway.sources.bronze import ingest_files, pending_files
from bronzeway.sources.files import list_source_files

REFERENCE, CLEAN = "reference", "clean"


def _normalised() -> dict[str, Column]:
    """First pass: case and null tokens of the columns that are looked at."""

    def plain(name: str, fill: str | None = None) -> Column:
        return null_token(F.col(name), v.NULL_TOKENS, fill)

    plain_columns = ["br", *v.TOKEN_ONLY_COLUMNS, *v.FLOAT_COLUMNS, *v.COUNT_COLUMNS]
    lowered_columns = ["causa_acidente", "tipo_acidente", "fase_dia", "condicao_metereologica"]
    return {
        **{name: plain(name) for name in plain_columns},
        **{name: null_token(F.lower(name), v.NULL_TOKENS) for name in lowered_columns},
        "dia_semana": lower_without(F.col("dia_semana"), v.WEEKDAY_SUFFIX),
        "classificacao_acidente": plain("classificacao_acidente", v.CLASSIFICATION_FILL),
        "tracado_via": plain("tracado_via", v.LAYOUT_FILL),
    }


def _typed(fidelity: str) -> dict[str, Column]:
    """Second pass: types and recodes."""
    spellings = {
        spelling.lower(): cause
        for cause, listed in v.CAUSE_GROUPS.items()
        for spelling in listed
    }
    return {
        "data_inversa": date_by_shape(
            F.col("data_inversa"), v.DATE_SHAPES, v.DATE_OTHERWISE
        ),
        "br": lenient_int(F.col("br")),
        "causa_acidente": lookup(F.col("causa_acidente"), spellings, v.CAUSES_TO_NULL),
        "tipo_acidente": by_rules(F.col("tipo_acidente"), v.TYPE_RULES),
        "condicao_metereologica": lookup(
            F.col("condicao_metereologica"), v.WEATHER_GROUPS, keep=fidelity == CLEAN
        ),
        **{name: comma_float(F.col(name)) for name in v.FLOAT_COLUMNS},
        **{name: lenient_int(F.col(name)) for name in v.COUNT_COLUMNS},
    }


def _published(fidelity: str) -> dict[str, Column]:
    """Third pass: text made from typed values."""
    missing = "null" if fidelity == REFERENCE else None
    return {"br": padded_code(F.col("br"), v.HIGHWAY_WIDTH, missing)}


def to_silver(
    bronze: DataFrame, fidelity: str = REFERENCE, keep: Sequence[str] = ()
) -> DataFrame:
    """Cleaned, typed rows, one per accident: projections only, no shuffle.

    Columns to ``keep`` pass through.

    ``reference`` keeps two oddities of the published data: a highway that is
    missing reads ``null``, and weather other than the recoded values is NULL.
    ``clean`` gives NULL and the lower-case text.
    """
    if fidelity not in (REFERENCE, CLEAN):
        raise ValueError(f"unknown fidelity: {fidelity}")
    rows = schema.project(bronze, [*v.SILVER_SOURCE_COLUMNS, *keep])
    # Passes, so that what one computes is a plain column to the next.
    for rules in (_normalised(), _typed(fidelity), _published(fidelity)):
        rows = schema.clean(rows, rules)
    return schema.rename(rows, {"data_inversa": "date"})


def to_gold(silver: DataFrame) -> DataFrame:
    """Accident counts and people by date, place, weather, cause and type."""
    return rollup.gold_rollup(
        silver, v.GOLD_KEYS, v.GOLD_COUNT, v.GOLD_FLAGS, v.GOLD_TOTALS
    )


def yearly_check(gold: DataFrame) -> DataFrame:
    """Accidents, people and deaths per year."""
    return rollup.yearly_totals(gold, "DATA", v.YEARLY_MEASURES, v.YEAR)


def format_profile(raw: DataFrame, limit: int | None = None) -> DataFrame:
    return profile.profile_formats(raw, v.FORMAT_PROFILE_COLUMNS, limit)


def value_profile(raw: DataFrame, limit: int | None = None) -> DataFrame:
    return profile.profile_values(raw, v.VALUE_PROFILE_COLUMNS, limit)


# --- reports over the gold table -------------------------------------------


def choices(gold: DataFrame) -> DataFrame:
    """Values a reader may select by: ``column, value``."""
    return filters.facets(gold, ["DS_TIPO", "SG_UF", "DS_BR"])


def selection(
    gold: DataFrame,
    years: tuple[int, int] | None = None,
    types: Sequence[str | None] = (),
    states: Sequence[str | None] = (),
    highways: Sequence[str | None] = (),
) -> DataFrame:
    """The part of the gold table a reader has selected."""
    return filters.facet_filter(
        gold, "DATA", years, {"DS_TIPO": types, "SG_UF": states, "DS_BR": highways}
    )


def cards(gold: DataFrame) -> DataFrame:
    """Accidents, people, injured and dead in total."""
    return rollup.kpi(gold, v.CARD_MEASURES)


def by_highway(gold: DataFrame, highways: DataFrame) -> DataFrame:
    """Highways with more than 1000 accidents and their dimension columns."""
    return joins.aggregate_and_join(
        gold, highways, v.GOLD_COUNT, "DS_BR", v.HIGHWAY_DIM_KEY, v.HIGHWAY_MIN_ACCIDENTS
    )


def by_state(gold: DataFrame, states: DataFrame) -> DataFrame:
    return joins.aggregate_and_join(gold, states, v.GOLD_COUNT, "SG_UF", v.STATE_DIM_KEY)


def map_classes(counts: DataFrame, classes: int = v.MAP_CLASSES) -> DataFrame:
    """Colour class of each row of a map."""
    return ranking.classify_equal_width(counts, v.GOLD_COUNT, classes)


def map_legend(counts: DataFrame, style: str = "mil") -> DataFrame:
    """Class limits of a map with the text shown for them."""
    breaks = ranking.class_breaks(counts, v.GOLD_COUNT, v.MAP_CLASSES)
    return display_number(breaks, "value", style, "label")


def count_table(counts: DataFrame, key: str, classes: int) -> DataFrame:
    """The 15 largest counts with their shade among the rows shown."""
    top = ranking.top_table(counts, key, v.GOLD_COUNT, v.TOP_TABLE_ROWS)
    shaded = ranking.classify_equal_width(top, v.GOLD_COUNT, classes)
    shown = display_number(shaded, v.GOLD_COUNT, "grouped", "shown")
    return schema.rename(shown, {v.GOLD_COUNT: v.COUNT_LABEL})


def causes(gold: DataFrame) -> DataFrame:
    """The ten main causes and the rest, as shares of all accidents."""
    sums = rollup.sum_by(gold, [v.GOLD_COUNT], ["DS_CAUSA"])
    top = ranking.top_n_with_others(
        sums, "DS_CAUSA", v.GOLD_COUNT, v.TOP_CAUSES, v.OTHERS_LABEL
    )
    return truncate_label(top, "DS_CAUSA", v.LABEL_WIDTH)


def death_rates(gold: DataFrame) -> DataFrame:
    """The ten accident types with the highest share of deaths."""
    rates = rollup.rate_by(
        gold, "DS_TIPO", "QT_TOTAL_MORTOS", "QT_TOTAL_PESSOAS", "TAXA_LETALIDADE"
    )
    top = ranking.top_table(rates, "DS_TIPO", "TAXA_LETALIDADE", v.TOP_RATES)
    return display_number(top, "TAXA_LETALIDADE", "pct1", "shown")


def accidents_by_year(gold: DataFrame) -> DataFrame:
    """Accidents per year in thousands, the highest year marked."""
    sums = rollup.sum_by(with_year(gold, "DATA", v.YEAR), [v.GOLD_COUNT], [v.YEAR])
    return display_number(ranking.flag_max(sums, v.GOLD_COUNT), v.GOLD_COUNT, "k1", "shown")


def dashboard(
    gold: DataFrame, highway_dim: DataFrame, state_dim: DataFrame, **selected
) -> Mapping[str, DataFrame]:
    """Every panel over one ``selection`` of the gold table.

    Cache the gold table, or the part of it that is often asked for, to draw
    several panels from it.
    """
    rows = selection(gold, **selected)
    highway_counts = by_highway(rows, highway_dim)
    state_counts = by_state(rows, state_dim)
    return {
        "cards": cards(rows),
        "highway_map": map_classes(highway_counts),
        "highway_legend": map_legend(highway_counts, "mil"),
        "highway_table": count_table(highway_counts, "DS_BR", v.TABLE_CLASSES_HIGHWAY),
        "state_map": map_classes(state_counts, v.STATE_MAP_CLASSES),
        "state_legend": map_legend(state_counts, "mil_round"),
        "state_table": count_table(state_counts, "SG_UF", v.TABLE_CLASSES_STATE),
        "causes": causes(rows),
        "death_rates": death_rates(rows),
        "accidents_by_year": accidents_by_year(rows),
    }


# What a panel shows: its label and its value.
_SHOWN = {
    "highway_map": ("DS_BR", "class"),
    "highway_legend": ("position", "label"),
    "highway_table": ("DS_BR", "shown"),
    "state_map": ("SG_UF", "class"),
    "state_legend": ("position", "label"),
    "state_table": ("SG_UF", "shown"),
    "causes": ("DS_CAUSA", v.GOLD_COUNT),
    "death_rates": ("DS_TIPO", "shown"),
    "accidents_by_year": (v.YEAR, "shown"),
}


def report(
    gold: DataFrame, highway_dim: DataFrame, state_dim: DataFrame, **selected
) -> DataFrame:
    """All panels of a selection as one frame of text: panel, label, value."""
    panels = dashboard(gold, highway_dim, state_dim, **selected)
    shown = [
        panels["cards"]
        .unpivot([], v.CARD_MEASURES, "label", "value")
        .select(F.lit("cards").alias("panel"), "label", F.col("value").cast("string"))
    ]
    for panel, (label, value) in _SHOWN.items():
        shown.append(
            panels[panel].select(
                F.lit(panel).alias("panel"),
                F.col(label).cast("string").alias("label"),
                F.col(value).cast("string").alias("value"),
            )
        )
    return reduce(DataFrame.unionByName, shown)


def load_raw(spark: SparkSession, folder: str, bronze: str, only_new: bool = False) -> None:
    """Source files of a folder into the bronze table."""
    if only_new:
        paths = pending_files(spark, folder, bronze)
    else:
        paths = [row.path for row in list_source_files(spark, folder).collect()]
    if paths:
        ingest_files(spark, paths, bronze)
