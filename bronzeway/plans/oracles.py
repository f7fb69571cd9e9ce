"""Each registered query once more in plain SQL, to check results against."""

from __future__ import annotations

from bronzeway import values as v
from bronzeway.plans import roles

_SILVER = f"({roles.sql(roles.SILVER)})"
_GOLD = f"({roles.sql(roles.GOLD)})"
_RAW = f"({roles.sql(roles.RAW)})"

COUNT = v.GOLD_COUNT


def _quoted(items) -> str:
    return ", ".join("'" + i.replace("'", "''") + "'" for i in items)


# Written out here once more, so that a wrong list in the package shows.
_TOKENS = _quoted(["(null)", "NA", "N/A", "null", "na", "n/a"])


def _no_token(c: str, fill: str = "NULL") -> str:
    return f"CASE WHEN {c} IS NULL OR {c} IN ({_TOKENS}) THEN {fill} ELSE {c} END"


def _date(c: str) -> str:
    return (
        f"CASE WHEN {c} LIKE '____-%' THEN cast(try_strptime({c}, '%Y-%m-%d') AS date)"
        f" WHEN {c} LIKE '%/%/__' THEN make_date(2000 + cast(substr({c}, 7, 2) AS int),"
        f" cast(substr({c}, 4, 2) AS int), cast(substr({c}, 1, 2) AS int))"
        f" ELSE cast(try_strptime({c}, '%d/%m/%Y') AS date) END"
    )


def _float(c: str) -> str:
    return f"try_cast(replace({_no_token(c)}, ',', '.') AS float)"


def _int(c: str) -> str:
    clean = _no_token(c)
    return (
        f"CASE WHEN regexp_full_match({clean}, '\\s*[+-]?[0-9]+(\\.[0-9]*)?\\s*')"
        f" THEN try_cast(trunc(try_cast({clean} AS double)) AS int) END"
    )


def _padded(c: str, missing: str) -> str:
    number = _int(c)
    return (
        f"CASE WHEN {number} IS NULL THEN {missing}"
        f" WHEN {number} < 1000 THEN lpad(cast({number} AS varchar), 3, '0')"
        f" ELSE cast({number} AS varchar) END"
    )


def _cause(c: str) -> str:
    low = _no_token(f"lower({c})")
    groups = " ".join(
        f"WHEN {low} IN ({_quoted(s.lower() for s in spellings)}) THEN {_quoted([cause])}"
        for cause, spellings in v.CAUSE_GROUPS.items()
    )
    return f"CASE WHEN {low} = 'outras' THEN NULL {groups} ELSE {low} END"


def _type(c: str) -> str:
    low = _no_token(f"lower({c})")
    return (
        f"CASE WHEN {low} LIKE '%colisão%' AND {low} LIKE '%objeto%' THEN 'colisão com objeto'"
        f" WHEN {low} LIKE '%queda%' THEN 'queda do veiculo'"
        f" WHEN {low} LIKE '%pedestre%' THEN replace({low}, 'pedestre', 'pessoa')"
        f" WHEN {low} = 'saída de leito carroçável' THEN 'saída de pista' ELSE {low} END"
    )


def _weather(c: str, rest: str) -> str:
    low = _no_token(f"lower({c})")
    return (
        f"CASE {low} WHEN 'nevoeiro/neblina' THEN 'nublado'"
        f" WHEN 'ceu claro' THEN 'céu claro' ELSE {rest if rest == 'NULL' else low} END"
    )


def _as_items(items: dict[str, str]) -> str:
    return ", ".join(f"{expr} AS {name}" for name, expr in items.items())


_SILVER_ITEMS = {
    "id": "id",
    "date": _date("data_inversa"),
    "dia_semana": "replace(lower(dia_semana), '-feira', '')",
    "horario": "horario",
    "uf": _no_token("uf"),
    "br": _padded("br", "'null'"),
    "km": _float("km"),
    "municipio": "municipio",
    "causa_acidente": _cause("causa_acidente"),
    "tipo_acidente": _type("tipo_acidente"),
    "classificacao_acidente": _no_token("classificacao_acidente", "'Ignorado'"),
    "fase_dia": _no_token("lower(fase_dia)"),
    "sentido_via": "sentido_via",
    "condicao_metereologica": _weather("condicao_metereologica", "NULL"),
    "tipo_pista": _no_token("tipo_pista"),
    "tracado_via": _no_token("tracado_via", "'Não Informado'"),
    "uso_solo": _no_token("uso_solo"),
    **{c: _int(c) for c in v.COUNT_COLUMNS},
    "latitude": _float("latitude"),
    "longitude": _float("longitude"),
}


def _rollup(source: str) -> str:
    keys = ", ".join(f"{c} AS {n}" for n, c in v.GOLD_KEYS.items() if n != "DATA")
    flags = ", ".join(
        f"sum(CASE WHEN {c} IS NOT NULL AND {c} > 0 THEN 1 ELSE 0 END)::bigint AS {n}"
        for n, c in v.GOLD_FLAGS.items()
    )
    totals = ", ".join(f"sum({c})::bigint AS {n}" for n, c in v.GOLD_TOTALS.items())
    by = ", ".join(v.GOLD_KEYS.values())
    return (
        f"SELECT cast(date AS varchar) AS DATA, {keys}, count(*) AS QT_ACIDENTES,"
        f" {flags}, {totals} FROM {source} GROUP BY {by}"
    )


def _sums(key: str) -> str:
    return (
        f"(SELECT {key}, sum({COUNT})::bigint AS {COUNT} FROM {_GOLD}"
        f" WHERE {key} IS NOT NULL GROUP BY {key})"
    )


def _classes(value: str, source: str, n: int) -> str:
    """Class of ``value`` among all rows of ``source``."""
    lo, hi = f"min({value}) OVER ()", f"max({value}) OVER ()"
    return (
        f"SELECT *, CASE WHEN {lo} = {hi} THEN 1 ELSE least(floor(({value} - {lo})"
        f" / cast({hi} - {lo} AS double) * {n}) + 1, {n}) END::int AS class FROM {source}"
    )


def _counts(facets: dict[str, str], source: str, with_n: bool = True) -> str:
    n = ", count(*) AS n" if with_n else ""
    return " UNION ALL ".join(
        f"SELECT '{name}' AS \"column\", cast({expr} AS varchar) AS value{n}"
        f" FROM {source} GROUP BY {expr}"
        for name, expr in facets.items()
    )


_EARLY = "coalesce(year(o_orderdate) < 1998, false)"
_DRIFTED = (
    f"SELECT o_orderkey, CASE WHEN {_EARLY} THEN o_custkey END AS o_custkey, o_orderstatus,"
    f" CASE WHEN NOT ({_EARLY}) THEN o_orderpriority END AS o_orderpriority,"
    f" CASE WHEN NOT ({_EARLY}) THEN cast(cast(o_orderdate AS date) AS varchar) END"
    f" AS o_orderdate FROM orders"
)
_DRIFTED_TEXT = (
    "SELECT cast(o_orderkey AS varchar) AS o_orderkey, cast(o_custkey AS varchar) AS o_custkey,"
    f" o_orderstatus, o_orderpriority, o_orderdate FROM ({_DRIFTED})"
)

_BR_COUNTS = (
    f"(SELECT DS_BR, {COUNT} FROM {_sums('DS_BR')}"
    f" JOIN supplier ON cast(s_suppkey AS varchar) = DS_BR WHERE {COUNT} > 1000)"
)
_UF_COUNTS = f"(SELECT SG_UF, {COUNT} FROM {_sums('SG_UF')} JOIN nation ON n_name = SG_UF)"


def _panel(counts: str, key: str, classes: int) -> str:
    top = f"(SELECT {key}, {COUNT} AS QTD FROM {counts} ORDER BY {COUNT} DESC, {key} LIMIT 15)"
    return (
        f"SELECT {key}, QTD, class, format('{{:,}}', QTD) AS shown"
        f" FROM ({_classes('QTD', top, classes)})"
    )


def _mil(x: str, small: str) -> str:
    return (
        f"CASE WHEN {x} >= 1000 THEN cast(cast(floor({x} / 1000) AS bigint) AS varchar)"
        f" || ' mil' ELSE cast(cast({small} AS bigint) AS varchar) END"
    )


_LINE = "CASE WHEN list_reverse(part) < part THEN list_reverse(part) ELSE part END"



def _digests(key: str, lines: str) -> str:
    return (
        f"SELECT {key}, count(*) AS n_parts, sum(len(line))::bigint AS n_numbers,"
        " sum(list_sum(list_transform(line, lambda x, i: i * cast(round(x * 1000) AS bigint))))"
        f"::bigint AS digest FROM {lines} GROUP BY 1"
    )


def _report() -> str:
    """All panels of one selection, from the statements of the single ones."""
    chosen = (
        f"(SELECT * FROM {_GOLD} WHERE year(DATA) BETWEEN 1996 AND 1999"
        " AND DS_TIPO IN ('1-URGENT', '5-LOW', '2-HIGH'))"
    )

    def sums(key: str) -> str:
        return (
            f"(SELECT {key}, sum({COUNT})::bigint AS {COUNT} FROM {chosen}"
            f" WHERE {key} IS NOT NULL GROUP BY {key})"
        )

    highways = (
        f"(SELECT DS_BR, {COUNT} FROM {sums('DS_BR')}"
        f" JOIN supplier ON cast(s_suppkey AS varchar) = DS_BR WHERE {COUNT} > 1000)"
    )
    states = f"(SELECT SG_UF, {COUNT} FROM {sums('SG_UF')} JOIN nation ON n_name = SG_UF)"

    def legend(counts: str, small: str) -> str:
        return (
            f"SELECT i AS label, {_mil('x', small)} AS value FROM (SELECT i,"
            f" lo + (hi - lo) * i / 6 AS x FROM (SELECT min({COUNT})::double AS lo,"
            f" max({COUNT})::double AS hi FROM {counts}), range(7) t(i))"
        )

    def table(counts: str, key: str) -> str:
        return (
            f"SELECT {key} AS label, format('{{:,}}', {COUNT}) AS value FROM (SELECT * FROM {counts}"
            f" ORDER BY {COUNT} DESC, {key} LIMIT 15)"
        )

    panels = {
        "cards": " UNION ALL ".join(
            f"SELECT '{m}' AS label, cast(coalesce(sum({m}), 0)::bigint AS varchar) AS value"
            f" FROM {chosen}"
            for m in v.CARD_MEASURES
        ),
        "highway_map": f"SELECT DS_BR AS label, class AS value FROM ({_classes(COUNT, highways, 6)})",
        "highway_legend": legend(highways, "trunc(x)"),
        "highway_table": table(highways, "DS_BR"),
        "state_map": f"SELECT SG_UF AS label, class AS value FROM ({_classes(COUNT, states, 256)})",
        "state_legend": legend(states, "round_even(x, 0)"),
        "state_table": table(states, "SG_UF"),
        "causes": (
            f"SELECT CASE WHEN place <= 10 THEN DS_CAUSA ELSE 'Outros' END AS label,"
            f" coalesce(sum({COUNT}), 0)::bigint AS value FROM (SELECT *, row_number() OVER"
            f" (ORDER BY {COUNT} DESC, DS_CAUSA) AS place FROM {sums('DS_CAUSA')} UNION ALL"
            " SELECT NULL, 0, 11) GROUP BY 1"
        ),
        "death_rates": (
            "SELECT DS_TIPO AS label, printf('%.1f', 100 * rate) || '%' AS value FROM (SELECT"
            " DS_TIPO, coalesce(sum(QT_TOTAL_MORTOS), 0) / nullif(coalesce(sum(QT_TOTAL_PESSOAS),"
            f" 0), 0) AS rate FROM {chosen} WHERE DS_TIPO IS NOT NULL GROUP BY DS_TIPO)"
        ),
        "accidents_by_year": (
            f"SELECT year(DATA) AS label, printf('%.1f', sum({COUNT}) / 1000.0::double) AS value"
            f" FROM {chosen} GROUP BY 1"
        ),
    }
    return " UNION ALL ".join(
        f"SELECT '{name}' AS panel, cast(label AS varchar) AS label, cast(value AS varchar) AS value"
        f" FROM ({statement})"
        for name, statement in panels.items()
    )


_REPORT = _report()

ORACLES = {
    "gold_rollup": _rollup(_SILVER),
    "gold_store": _rollup(_SILVER),
    "yearly_totals": (
        "SELECT year(o_orderdate)::int AS ANO, count(*) AS QT_PEDIDOS_ANO,"
        " sum(cast(round(o_totalprice) AS bigint))::bigint AS QT_PRECO_ANO"
        " FROM orders GROUP BY 1 ORDER BY 1"
    ),
    "yearly_check": (
        "SELECT year(date)::int AS ANO, count(*) AS QT_ACIDENTES_ANO,"
        " sum(pessoas)::bigint AS QT_PESSOAS, sum(mortos)::bigint AS QT_MORTOS"
        f" FROM {_SILVER} GROUP BY 1 ORDER BY 1"
    ),
    "null_token_clean": (
        f"SELECT id, {_no_token('uf')} AS uf, {_no_token('tipo_pista')} AS tipo_pista,"
        f" {_no_token('uso_solo')} AS uso_solo FROM {_RAW}"
    ),
    "default_token_fill": (
        f"SELECT id, {_no_token('classificacao_acidente', _quoted(['Ignorado']))}"
        " AS classificacao_acidente,"
        f" {_no_token('tracado_via', _quoted(['Não Informado']))} AS tracado_via FROM {_RAW}"
    ),
    "lower_strip_suffix": (
        "SELECT id, regexp_replace(lower(dia_semana), '-feira', '', 'g') AS dia_semana,"
        f" lower(fase_dia) AS fase_dia FROM {_RAW}"
    ),
    "multi_format_date": (
        "SELECT event_id, CASE WHEN event_id % 4 < 3"
        " THEN cast(cast(ts AS date) AS varchar) END AS day FROM events"
    ),
    "decimal_comma": (
        f"SELECT id, {_as_items({c: _float(c) for c in v.FLOAT_COLUMNS})} FROM {_RAW}"
    ),
    "safe_int": f"SELECT id, {_as_items({c: _int(c) for c in v.COUNT_COLUMNS})} FROM {_RAW}",
    "zero_pad": f"SELECT id, {_padded('br', _quoted(['null']))} AS br FROM {_RAW}",
    "recode_map": (
        "SELECT p_partkey, CASE WHEN n = 25 THEN NULL WHEN n BETWEEN 1 AND 20 AND n % 5 <> 0"
        " THEN 'Grupo ' || cast(n % 4 AS varchar) ELSE p_brand END AS p_brand"
        " FROM (SELECT *, cast(substr(p_brand, 7) AS int) AS n FROM part)"
    ),
    "recode_join": (
        "SELECT l_orderkey, l_linenumber, CASE WHEN l_partkey % 3 <> 0 AND p_partkey IS NOT NULL"
        " THEN p_brand ELSE cast(l_partkey AS varchar) END AS code"
        " FROM lineitem LEFT JOIN part ON p_partkey = l_partkey"
    ),
    "contains_recode": (
        "SELECT p_partkey, CASE WHEN contains(p_name, 'red') AND contains(p_name, 'widget')"
        " THEN 'red thing' WHEN contains(p_name, 'small') THEN 'small thing'"
        " WHEN contains(p_name, 'bolt') THEN replace(p_name, 'bolt', 'screw')"
        " WHEN p_name = 'hot gear' THEN 'gear' ELSE p_name END AS p_name FROM part"
    ),
    "partial_recode": (
        "SELECT p_partkey, CASE p_type WHEN 'SMALL' THEN 'pequeno' WHEN 'LARGE' THEN 'grande'"
        " END AS p_type FROM part"
    ),
    "silver_clean": (
        "SELECT * REPLACE (cast(date AS varchar) AS date) FROM"
        f" (SELECT {_as_items(_SILVER_ITEMS)} FROM {_RAW})"
    ),
    "silver_clean_strict": (
        f"SELECT id, {_padded('br', 'NULL')} AS br,"
        f" {_weather('condicao_metereologica', 'keep')} AS condicao_metereologica,"
        f" {_cause('causa_acidente')} AS causa_acidente FROM {_RAW}"
    ),
    "rename_project": (
        "SELECT o_orderkey AS id, o_orderstatus AS DS_FASE, o_orderpriority AS DS_TIPO FROM orders"
    ),
    "schema_drift_union": _DRIFTED,
    "bronze_append": (
        f"SELECT *, CASE WHEN o_custkey IS NOT NULL THEN 'early' ELSE 'late' END"
        f" AS source_filename FROM ({_DRIFTED})"
    ),
    "bronze_csv_roundtrip": (
        "SELECT cast(o_orderkey AS varchar) AS o_orderkey, cast(o_custkey AS varchar) AS o_custkey,"
        " o_orderstatus, cast(o_orderdate AS varchar) AS o_orderdate, o_orderpriority FROM orders"
    ),
    "incremental_idempotent": _DRIFTED_TEXT,
    "incremental_new_files": _DRIFTED_TEXT,
    "provenance_counts": (
        f"SELECT CASE WHEN {_EARLY} THEN 'early' ELSE 'late' END AS delivery,"
        " count(*) AS n_rows FROM orders GROUP BY 1"
    ),
    "common_columns": (
        "SELECT 'o_orderkey' AS \"column\", count(o_orderkey) AS n_filled FROM orders UNION ALL"
        " SELECT 'o_orderstatus', count(o_orderstatus) FROM orders"
    ),
    "described_columns": (
        "SELECT \"column\", position::int AS position, type, n_filled FROM ("
        + " UNION ALL ".join(
            f"SELECT '{c}' AS \"column\", {i} AS position, '{t}' AS type,"
            f" count({c}) AS n_filled FROM ({_DRIFTED})"
            for i, (c, t) in enumerate(
                [
                    ("o_orderkey", "bigint"), ("o_custkey", "bigint"),
                    ("o_orderstatus", "string"), ("o_orderpriority", "string"),
                    ("o_orderdate", "date"),
                ],
                start=1,
            )
        )
        + ")"
    ),
    "medallion_gold": _rollup(f"(SELECT {_as_items(_SILVER_ITEMS)} FROM {_RAW})"),
    "profile_number_formats": _counts(
        {c: f"regexp_replace({c}, '[0-9]', 'D', 'g')" for c in v.FORMAT_PROFILE_COLUMNS}, _RAW
    ),
    "profile_distinct": _counts({c: c for c in v.VALUE_PROFILE_COLUMNS}, _RAW),
    "profile_first_values": (
        "SELECT \"column\", value, n FROM (SELECT *, row_number() OVER"
        " (PARTITION BY \"column\" ORDER BY value) AS place FROM ("
        + _counts({c: c for c in ["l_returnflag", "l_partkey", "l_suppkey"]}, "lineitem")
        + ")) WHERE place <= 200"
    ),
    "distinct_values": "SELECT DISTINCT o_orderpriority FROM orders",
    "position_all": (
        "SELECT o_orderkey, QT_PRECO, round(QT_PRECO / sum(QT_PRECO) OVER (), 6) AS PERCENTUAL,"
        " row_number() OVER (ORDER BY QT_PRECO DESC NULLS LAST, o_orderkey) AS position"
        " FROM (SELECT o_orderkey, cast(round(o_totalprice) AS bigint) AS QT_PRECO FROM orders)"
    ),
    "peek_rows": "SELECT o_orderkey, o_orderstatus FROM orders ORDER BY o_orderkey LIMIT 200",
    "sample_rows": (
        "SELECT o_orderkey, o_custkey FROM orders WHERE cast('0x' ||"
        " substr(md5('214:' || cast(o_orderkey AS varchar)), 1, 8) AS bigint)"
        " < cast(floor(0.05 * 4294967296) AS bigint)"
    ),
    "filter_facets": _counts(
        {c: c for c in ["DS_TIPO", "SG_UF", "DS_BR"]}, _GOLD, with_n=False
    ),
    "filter_years": (
        f"SELECT min(year(DATA))::int AS min_year, max(year(DATA))::int AS max_year FROM {_GOLD}"
    ),
    "facet_filter": (
        f"SELECT * REPLACE (cast(DATA AS varchar) AS DATA) FROM {_GOLD}"
        " WHERE year(DATA) >= 1996 AND year(DATA) <= 1999"
        " AND DS_TIPO IN ('1-URGENT', '5-LOW')"
        f" AND (SG_UF IS NULL OR SG_UF IN ({_quoted(f'NATION_{i}' for i in range(12))}))"
    ),
    "facet_filter_many": (
        f"SELECT DS_BR, {COUNT} FROM {_GOLD}"
        " WHERE cast(DS_BR AS bigint) % 2 = 0 AND cast(DS_BR AS bigint) < 3000"
    ),
    "kpi_cards": (
        "SELECT "
        + ", ".join(f"coalesce(sum({m}), 0)::bigint AS {m}" for m in v.CARD_MEASURES)
        + f" FROM {_GOLD}"
    ),
    "dim_join_counts": (
        f"SELECT n.*, s.SG_UF, s.{COUNT} FROM nation n JOIN {_sums('SG_UF')} s ON n_name = SG_UF"
    ),
    "dim_join_having": (
        f"SELECT cast(s_suppkey AS varchar) AS vl_br, s_name, DS_BR, {COUNT} FROM supplier"
        f" JOIN {_sums('DS_BR')} ON cast(s_suppkey AS varchar) = DS_BR WHERE {COUNT} > 1000"
    ),
    "top15_by_count": (
        f"SELECT DS_CAUSA, {COUNT} AS QTD FROM {_sums('DS_CAUSA')}"
        f" ORDER BY {COUNT} DESC, DS_CAUSA LIMIT 15"
    ),
    "share_topn_others": (
        f"WITH ranked AS (SELECT *, row_number() OVER (ORDER BY {COUNT} DESC, DS_CAUSA) AS place,"
        f" {COUNT} / sum({COUNT}) OVER () AS share FROM {_sums('DS_CAUSA')})"
        f" SELECT DS_CAUSA, {COUNT}, round(share, 6) AS PERCENTUAL FROM ranked WHERE place <= 10"
        f" UNION ALL SELECT 'Outros', coalesce(sum({COUNT}), 0)::bigint,"
        " round(coalesce(sum(share), 0), 6) FROM ranked WHERE place > 10"
    ),
    "share_of_total": (
        f"SELECT DS_BR, {COUNT}, round({COUNT} / sum({COUNT}) OVER (), 6) AS PERCENTUAL"
        f" FROM {_sums('DS_BR')}"
    ),
    "rate_top10": (
        "SELECT DS_TIPO, round(rate, 6) AS TAXA_LETALIDADE,"
        " printf('%.1f', 100 * rate) || '%' AS shown FROM (SELECT DS_TIPO,"
        " coalesce(sum(QT_TOTAL_MORTOS), 0) / nullif(coalesce(sum(QT_TOTAL_PESSOAS), 0), 0)"
        f" AS rate FROM {_GOLD} WHERE DS_TIPO IS NOT NULL GROUP BY DS_TIPO)"
        " ORDER BY rate DESC NULLS LAST, DS_TIPO LIMIT 10"
    ),
    "year_bars": (
        f"SELECT ANO, {COUNT}, {COUNT} = max({COUNT}) OVER () AS is_max,"
        f" printf('%.1f', {COUNT} / 1000.0::double) AS shown FROM (SELECT year(DATA)::int AS ANO,"
        f" sum({COUNT})::bigint AS {COUNT} FROM {_GOLD} WHERE DATA IS NOT NULL GROUP BY 1)"
    ),
    "class_breaks": (
        "SELECT i::int AS position, round(lo + (hi - lo) * i / 6, 6) AS value FROM"
        f" (SELECT min({COUNT})::double AS lo, max({COUNT})::double AS hi FROM {_sums('SG_UF')}),"
        " range(7) t(i)"
    ),
    "equal_width_classes": _classes(COUNT, _sums("SG_UF"), 6),
    "minmax_scale": (
        f"SELECT DS_CAUSA, {COUNT}, round(({COUNT} - min({COUNT}) OVER ())"
        f" / (max({COUNT}) OVER () - min({COUNT}) OVER ())::double, 6) AS scaled FROM"
        f" (SELECT * FROM {_sums('DS_CAUSA')} ORDER BY {COUNT} DESC, DS_CAUSA LIMIT 15)"
    ),
    "highway_panel": _panel(_BR_COUNTS, "DS_BR", 6),
    "state_panel": _panel(_UF_COUNTS, "SG_UF", 256),
    "map_legend": (
        f"SELECT i::int AS position, {_mil('x', 'trunc(x)')} AS label FROM"
        " (SELECT i, lo + (hi - lo) * i / 6 AS x FROM (SELECT"
        f" min({COUNT})::double AS lo, max({COUNT})::double AS hi FROM {_UF_COUNTS}),"
        " range(7) t(i))"
    ),
    "label_truncate": (
        "SELECT doc_id, CASE WHEN length(text) < 35 THEN text"
        " ELSE substr(text, 1, 35) || '...' END AS text, source FROM documents"
    ),
    "display_numbers": (
        f"SELECT SG_UF, {COUNT}, format('{{:,}}', {COUNT}) AS grouped,"
        f" {_mil(COUNT, COUNT)} AS mil, {_mil(COUNT, COUNT)} AS mil_round,"
        f" printf('%.1f', {COUNT} / 1000.0::double) AS k1 FROM {_sums('SG_UF')}"
    ),
    "selected_panels": " UNION ALL ".join(
        f"SELECT '{key}' AS panel, {key} AS label, sum({COUNT})::bigint AS {COUNT}"
        f" FROM {_GOLD} WHERE {key} IS NOT NULL AND year(DATA) BETWEEN 1996 AND 1999 GROUP BY {key}"
        for key in ("SG_UF", "DS_CAUSA")
    ),
    "geo_dissolve": _digests(
        "label", f"(SELECT DISTINCT label, {_LINE} AS line FROM (SELECT label,"
        " embedding::double[] AS part FROM embeddings))"
    ),
    "geojson_lines": _digests(
        "label AS vl_br",
        f"(SELECT DISTINCT label, flatten({_LINE}) AS line FROM (SELECT label,"
        " list_transform(range(0, len(embedding) - 1, 2),"
        " lambda i: embedding[i + 1:i + 2]::double[]) AS part FROM embeddings))",
    ),
    "geojson_collections": _digests(
        "vl_br",
        f"(SELECT DISTINCT vl_br, flatten({_LINE}) AS line FROM ("
        "SELECT cast(s_suppkey % 5 AS varchar) AS vl_br,"
        " [[s_suppkey::double, 0.5], [(s_suppkey % 7)::double, 2.0]] AS part FROM supplier UNION ALL"
        " SELECT cast(s_suppkey % 5 AS varchar), [[1.0::double, s_suppkey::double], [3.0, 4.0]]"
        " FROM supplier WHERE s_suppkey % 2 <> 0))",
    ),
    "topojson_join": (
        f"SELECT cast(n_nationkey AS varchar) AS id, n_name AS name, s.SG_UF, s.{COUNT}"
        f" FROM nation JOIN (SELECT cast(s_nationkey AS varchar) AS SG_UF, count(*) AS {COUNT}"
        " FROM supplier GROUP BY 1) s ON s.SG_UF = cast(n_nationkey AS varchar)"
    ),
    "sample_bernoulli": (
        "SELECT 0::bigint AS outside, 0::bigint AS repeated, count(*) > 0 AS share_ok FROM orders"
    ),
    "rate_edges": (
        "SELECT 'T' || k AS DS_TIPO, round(CASE WHEN people = 0 THEN CASE WHEN dead > 0 THEN"
        " 'infinity'::double END ELSE dead / people END, 6) AS rate FROM (SELECT l_partkey % 14 AS k,"
        " sum(CASE WHEN l_partkey % 14 = 5 THEN 0 ELSE l_linenumber % 3 END) AS dead,"
        " coalesce(sum(CASE WHEN l_partkey % 14 BETWEEN 3 AND 5 THEN 0 WHEN l_partkey % 14 > 5"
        " THEN trunc(l_quantity) END), 0) AS people FROM lineitem GROUP BY 1)"
        " ORDER BY rate DESC NULLS LAST, DS_TIPO LIMIT 10"
    ),
    "facet_filter_typed": (
        "SELECT o_orderkey, cast(cast(o_orderdate AS date) AS varchar) AS day, o_custkey FROM orders"
        " WHERE o_custkey % 2 = 0 AND o_custkey < 2400 AND day(o_orderdate) % 2 = 1"
        " AND day(o_orderdate) < 29 AND year(o_orderdate) BETWEEN 1995 AND 2001"
    ),
    "incremental_replaced": (
        "SELECT o_orderkey, o_orderstatus, unnest(CASE WHEN o_orderkey % 3 = 0 THEN"
        f" ['early', 'kept'] ELSE ['kept'] END) AS source_filename FROM orders WHERE {_EARLY}"
    ),
    "odd_headers": (
        "SELECT cast(o_orderkey AS varchar) AS o_orderkey, o_orderstatus AS code,"
        " o_orderpriority AS _c2, NULL::varchar AS code1, NULL::varchar AS code2,"
        " NULL::varchar AS status FROM orders"
        " UNION ALL SELECT cast(o_orderkey AS varchar), NULL, NULL, o_orderstatus,"
        " cast(cast(o_orderdate AS date) AS varchar), NULL FROM orders"
        " UNION ALL SELECT cast(o_orderkey AS varchar), NULL, NULL, NULL, NULL, o_orderstatus FROM orders"
    ),
    "topojson_rings": (
        "SELECT k::varchar AS id, name, 'states' AS object, count(*)::int AS n_rings,"
        " (5 * count(*))::int AS n_points, round(0.125::double * count(*), 6) AS area,"
        " round(sum(0.5 * (5 * (cell % 5) + 2) - 350), 6)::double AS sum_x,"
        " round(sum(0.25 * (5 * (cell // 5) + 2) - 150), 6)::double AS sum_y, true AS closed"
        " FROM (SELECT n_nationkey AS k, n_name AS name, unnest(CASE WHEN n_nationkey % 5 = 4"
        " THEN [n_nationkey, n_nationkey + 100] ELSE [n_nationkey] END) AS cell FROM nation)"
        " GROUP BY k, name"
    ),
    "layers_reconciled": (
        "WITH r AS (SELECT CASE WHEN year(l_shipdate) < 1998 THEN 1 WHEN year(l_shipdate) < 2000 THEN 2"
        " ELSE 3 END AS s, l_linenumber % 10 IN (1, 2) AS few FROM lineitem),"
        " n AS (SELECT count(*) FILTER (s = 1) AS a, count(*) FILTER (s = 2) AS b,"
        " count(*) FILTER (s = 2 AND few) AS c, count(*) FILTER (s = 3) AS d FROM r),"
        " runs AS (SELECT 1 AS run, a + b AS changed, a + b AS total FROM n"
        " UNION ALL SELECT 2, c + d, a + c + d FROM n UNION ALL SELECT 3, 0, c + d FROM n)"
        " SELECT run::BIGINT AS run, layer, CASE layer WHEN 'gold' THEN total ELSE changed END AS rows,"
        " CASE layer WHEN 'gold' THEN total ELSE changed END AS expected, true AS agrees"
        " FROM runs, (VALUES ('silver'), ('parts'), ('gold')) l(layer)"
    ),
    "sample_blocks_bronze": (
        "SELECT 0::BIGINT AS outside, 0::BIGINT AS repeated, true AS share_ok, true AS weights_ok,"
        " true AS files_ok FROM orders LIMIT 1"
    ),
    "report_kept": _REPORT,
    "incremental_changed": (
        "SELECT cast(o_orderkey AS varchar) AS o_orderkey,"
        " CASE WHEN y < 1997 THEN lower(o_orderstatus) ELSE o_orderstatus END AS o_orderstatus,"
        " cast(cast(o_orderdate AS date) AS varchar) AS o_orderdate, 'changed emptied new' AS pending"
        " FROM (SELECT *, coalesce(year(o_orderdate), 0) AS y FROM orders) WHERE y <> 1997"
    ),
    "gold_incremental": _rollup(
        f"(SELECT {_as_items(_SILVER_ITEMS)} FROM (SELECT * FROM"
        f" ({roles.sql({**roles.RAW, '_slice': 'year(l_shipdate)'})})"
        " WHERE _slice >= 2000 OR (_slice >= 1998 AND right(id, 1) IN ('1', '2')) OR _slice IS NULL))"
    ),
    "report_panels": _REPORT,
}
