"""Accident-like frames made from the star-schema tables.

The tables at hand hold no accidents, so their columns play the parts. The
expressions are written in SQL that Spark and other engines share, which lets a
check build the same rows elsewhere. A frame joins only the tables that the
columns asked for need.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bronzeway import values as v

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _text(value: str | None) -> str:
    return "NULL" if value is None else "'" + value.replace("'", "''") + "'"


def pick(number: str, values: Sequence[str | None]) -> str:
    """CASE expression that walks through ``values`` by a whole number."""
    branches = " ".join(f"WHEN {i} THEN {_text(x)}" for i, x in enumerate(values))
    return f"CASE cast(({number}) % {len(values)} AS int) {branches} END"


def _digits(number: str, width: int) -> str:
    return f"lpad(cast({number} AS string), {width}, '0')"


def day_text(date: str, order: str, short_year: bool = False) -> str:
    """A date as text, ``iso`` or ``dmy``."""
    year, month, day = f"year({date})", _digits(f"month({date})", 2), _digits(f"day({date})", 2)
    if order == "iso":
        return f"{_digits(year, 4)} || '-' || {month} || '-' || {day}"
    shown = _digits(f"{year} % 100", 2) if short_year else _digits(year, 4)
    return f"{day} || '/' || {month} || '/' || {shown}"


_INJURED_LIGHT = "cast((l_orderkey + 2 * l_linenumber) % 4 AS int)"
_INJURED_BADLY = "cast(l_linenumber % 3 AS int)"
_DEAD = "CASE WHEN l_orderkey % 11 <> 0 THEN cast((l_orderkey + l_linenumber) % 3 AS int) END"
_UNKNOWN = "CASE WHEN l_orderkey % 11 <> 0 THEN cast(l_orderkey % 2 AS int) END"

# Typed rows, one per accident, with keys coarse enough for groups of many rows.
SILVER = {
    "date": "make_date(cast(year(l_shipdate) AS int), 1, 1)",
    "dia_semana": pick("l_linenumber", ["segunda", "sexta", "domingo"]),
    "fase_dia": "CASE WHEN l_orderkey % 13 <> 0 THEN l_returnflag END",
    "condicao_metereologica": "l_linestatus",
    "uf": "CASE WHEN l_orderkey % 17 <> 0 THEN 'UF ' || cast(n_regionkey % 2 AS string) END",
    "br": "cast(l_suppkey % 2 AS string)",
    "causa_acidente": "CASE WHEN p_size < 25 THEN 'sono' ELSE 'chuva' END",
    "tipo_acidente": "CASE WHEN o_orderpriority < '3' THEN 'colisão' END",
    "pessoas": "cast(l_quantity AS int)",
    "ilesos": "cast(l_linenumber % 4 AS int)",
    "feridos": f"{_INJURED_LIGHT} + {_INJURED_BADLY}",
    "feridos_leves": _INJURED_LIGHT,
    "feridos_graves": _INJURED_BADLY,
    # No value at all in the groups of one weekday.
    "mortos": f"CASE WHEN l_linenumber % 3 <> 2 THEN {_DEAD} END",
    "ignorados": _UNKNOWN,
}

# Rows of a gold table, with the line number as the count of accidents. Some
# keys are NULL, as they are in the published table.
GOLD = {
    "DATA": "cast(l_shipdate AS date)",
    "SG_UF": "CASE WHEN l_orderkey % 17 <> 0 THEN n_name END",
    "DS_BR": "CASE WHEN l_orderkey % 19 <> 0 THEN cast(l_suppkey AS string) END",
    "DS_CAUSA": "CASE WHEN l_orderkey % 23 <> 0 THEN p_brand END",
    "DS_TIPO": "o_orderpriority",
    "QT_ACIDENTES": "cast(l_linenumber AS bigint)",
    "QT_TOTAL_PESSOAS": "cast(l_quantity AS bigint)",
    "QT_TOTAL_FERIDOS": "cast((l_orderkey + l_linenumber) % 5 AS bigint)",
    "QT_TOTAL_MORTOS": f"cast({_DEAD} AS bigint)",
}

# Source rows as text, with the untidiness of the published files.
RAW = {
    "id": "cast(l_orderkey AS string) || '-' || cast(l_linenumber AS string)",
    "data_inversa": (
        "CASE WHEN l_orderkey % 97 = 0 THEN '31/02/2010'"
        " WHEN l_orderkey % 89 = 0 THEN 'xx'"
        f" WHEN l_linenumber % 3 = 0 THEN {day_text('l_shipdate', 'iso')}"
        f" WHEN l_linenumber % 3 = 1 THEN {day_text('l_shipdate', 'dmy', short_year=True)}"
        f" ELSE {day_text('l_shipdate', 'dmy')} END"
    ),
    "dia_semana": pick(
        "l_orderkey",
        ["Segunda-feira", "Terça-feira", "Quarta-feira", "Quinta", "Sexta-Feira", "Sábado",
         "Domingo"],
    ),
    "horario": f"{_digits('l_orderkey % 24', 2)} || ':' || {_digits('l_partkey % 60', 2)} || ':00'",
    "uf": pick("l_suppkey", ["SP", "MG", "PR", "(null)", "SC", "BA", None, "RS", "null", "RJ"]),
    "br": (
        "CASE cast(l_orderkey % 9 AS int) WHEN 0 THEN 'NA' WHEN 1 THEN '(null)'"
        " WHEN 2 THEN cast(l_suppkey AS string) || '.0' WHEN 3 THEN '1e3'"
        " ELSE cast(l_suppkey AS string) END"
    ),
    "km": (
        "CASE cast(l_partkey % 6 AS int) WHEN 0 THEN '(null)' WHEN 1 THEN '1.234,5'"
        " WHEN 2 THEN cast(cast(l_quantity AS int) AS string)"
        " ELSE cast(cast(l_quantity AS int) AS string) || ',' ||"
        " cast(l_linenumber AS string) END"
    ),
    "municipio": "'CIDADE ' || cast(l_suppkey % 500 AS string)",
    "causa_acidente": pick(
        "l_partkey",
        [
            *(s for spellings in v.CAUSE_GROUPS.values() for s in spellings),
            "Outras", "Velocidade Incompatível", "Animais na Pista", "(null)", "NA", None,
        ],
    ),
    "tipo_acidente": pick(
        "l_partkey + l_linenumber",
        ["Colisão com objeto fixo", "Colisão com objeto em movimento", "Colisão frontal",
         "Queda de motocicleta", "Atropelamento de pedestre", "Saída de leito carroçável",
         "Saída de Pista", "Capotamento", "(null)", "N/A", None],
    ),
    "classificacao_acidente": pick(
        "l_orderkey", ["Sem Vítimas", "(null)", "Com Vítimas Fatais", None, "Ignorado"]
    ),
    "fase_dia": pick("l_suppkey", ["Pleno dia", "Plena Noite", "(null)", "Anoitecer"]),
    "sentido_via": pick("l_linenumber", ["Crescente", "Decrescente"]),
    "condicao_metereologica": pick(
        "l_orderkey",
        ["Nevoeiro/Neblina", "Ceu Claro", "Céu Claro", "Sol", "Chuva", "(null)", "Nublado"],
    ),
    "tipo_pista": pick("l_orderkey", ["Simples", "Dupla", "(null)"]),
    "tracado_via": pick("l_partkey", ["Reta", "Curva", "(null)", None]),
    "uso_solo": pick("l_partkey", ["Sim", "Não", "N/A"]),
    "pessoas": (
        "CASE cast(l_orderkey % 8 AS int) WHEN 0 THEN 'NA'"
        " WHEN 1 THEN cast(cast(l_quantity AS int) AS string) || '.9'"
        " WHEN 2 THEN ' ' || cast(cast(l_quantity AS int) AS string) || ' '"
        " ELSE cast(cast(l_quantity AS int) AS string) END"
    ),
    "mortos": pick("l_orderkey + l_linenumber", ["0", "0", "0", "1", "2", "(null)", "abc"]),
    "feridos_leves": (
        "CASE WHEN l_orderkey % 101 = 0 THEN '3000000000'"
        " ELSE cast(l_orderkey % 3 AS string) END"
    ),
    "feridos_graves": pick("l_linenumber", ["0", "1", "-1.9"]),
    "ilesos": pick("l_linenumber", ["0", "1", "2", "N/A"]),
    "ignorados": pick("l_orderkey", ["0", "1", "null"]),
    "feridos": pick("l_orderkey + l_linenumber", ["0", "1", "2", "3", "1e3"]),
    "veiculos": pick("l_linenumber", ["1", "2", "3"]),
    "latitude": "'-23,' || cast(l_orderkey % 1000 AS string)",
    "longitude": "CASE WHEN l_orderkey % 7 = 0 THEN 'null'"
                 " ELSE '-46.' || cast(l_partkey % 1000 AS string) END",
    "regional": "'REG-' || cast(l_suppkey % 27 AS string)",
    "delegacia": "'DEL' || cast(l_suppkey % 9 AS string)",
    "uop": "'UOP' || cast(l_suppkey % 5 AS string)",
}

# Joined table, its condition, and the prefix of the columns that need it.
_JOINS = [
    ("supplier", "l_suppkey = s_suppkey", ("n_",)),
    ("nation", "s_nationkey = n_nationkey", ("n_",)),
    ("part", "l_partkey = p_partkey", ("p_",)),
    ("orders", "l_orderkey = o_orderkey", ("o_",)),
]


def _joins(expressions: Sequence[str]) -> list[tuple[str, str]]:
    used = " ".join(expressions).replace("(", " ").replace(",", " ").split()
    return [
        (name, condition)
        for name, condition, prefixes in _JOINS
        if any(word.startswith(prefixes) for word in used)
    ]


def sql(roles: dict[str, str], columns: Sequence[str] | None = None) -> str:
    """SELECT statement of the frame."""
    chosen = {c: roles[c] for c in columns or roles}
    joins = " ".join(f"LEFT JOIN {t} ON {on}" for t, on in _joins(list(chosen.values())))
    items = ", ".join(f"{expr} AS {name}" for name, expr in chosen.items())
    return f"SELECT {items} FROM lineitem {joins}"


def frame(
    spark: SparkSession,
    folder: str,
    roles: dict[str, str],
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """Rows of lineitem with what they have in the other tables."""
    chosen = {c: roles[c] for c in columns or roles}
    rows = table(spark, folder, "lineitem")
    for name, condition in _joins(list(chosen.values())):
        rows = rows.join(table(spark, folder, name), F.expr(condition), "left")
    return rows.selectExpr(*(f"{expr} AS {name}" for name, expr in chosen.items()))
