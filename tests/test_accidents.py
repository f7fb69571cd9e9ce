import datetime

import pytest

from bronzeway import jobs, values as v
from bronzeway.plans import accidents
from bronzeway.session import scratch_path
from bronzeway.sources.bronze import read_bronze
from bronzeway.sources.tables import cached, read_table

BASE = {
    "id": "1", "data_inversa": "2017-01-31", "dia_semana": "Terça-feira", "horario": "10:00:00",
    "uf": "SP", "br": "101", "km": "12,5", "municipio": "X", "causa_acidente": "Outras",
    "tipo_acidente": "Capotamento", "classificacao_acidente": "(null)", "fase_dia": "Pleno dia",
    "sentido_via": "Crescente", "condicao_metereologica": "Sol", "tipo_pista": "Dupla",
    "tracado_via": "NA", "uso_solo": "N/A", "pessoas": "2", "mortos": "0", "feridos_leves": "1",
    "feridos_graves": "NA", "ilesos": "1", "ignorados": "0", "feridos": "1", "veiculos": "1.9",
    "latitude": "-23,5", "longitude": "null", "regional": "r", "delegacia": "d", "uop": "u",
}
LEAN = [c for c in v.RAW_COLUMNS if c not in ("latitude", "longitude", "regional", "delegacia", "uop")]


def accident(**changes):
    return {**BASE, **changes}


def deliver(folder, name, columns, accidents_):
    lines = [";".join(columns)]
    for a in accidents_:
        lines.append(";".join(a[c.lower()] or "" for c in columns))
    (folder / name).write_bytes(("\n".join(lines) + "\n").encode("latin-1"))


@pytest.fixture
def raw(spark):
    def make(**changes):
        data = [tuple(accident(**changes)[c] for c in v.RAW_COLUMNS)]
        return spark.createDataFrame(data, ", ".join(f"{c} string" for c in v.RAW_COLUMNS))

    return make


def silver(raw, fidelity="reference", **changes):
    return accidents.to_silver(raw(**changes), fidelity).first()


def test_silver_schema(raw):
    types = dict(accidents.to_silver(raw()).dtypes)
    assert list(types) == [{"data_inversa": "date"}.get(c, c) for c in v.RAW_COLUMNS[:-3]]
    assert types["date"] == "date"
    assert {types[c] for c in v.COUNT_COLUMNS} == {"int"}
    assert {types[c] for c in v.FLOAT_COLUMNS} == {"float"}


def test_silver_row(raw):
    row = silver(raw)
    assert row.date == datetime.date(2017, 1, 31) and row.dia_semana == "terça"
    assert (row.br, row.km, row.latitude, row.longitude) == ("101", 12.5, -23.5, None)
    assert (row.causa_acidente, row.tipo_acidente) == (None, "capotamento")
    assert (row.classificacao_acidente, row.tracado_via) == ("Ignorado", "Não Informado")
    assert (row.uso_solo, row.feridos_graves, row.veiculos) == (None, None, 1)
    assert (row.horario, row.municipio, row.sentido_via) == ("10:00:00", "X", "Crescente")


@pytest.mark.parametrize(
    "given, expected",
    [
        ("Ingestão de Álcool", "Ingestão de álcool ou psicoativos"),
        ("FALTA DE ATENÇÃO", "Falta de atenção"),
        ("Dormindo", "Condutor dormindo"),
        ("Animais na Pista", "animais na pista"),
        ("NA", None),
        ("outras", None),
        (None, None),
    ],
)
def test_causes(raw, given, expected):
    assert silver(raw, causa_acidente=given).causa_acidente == expected


def test_every_listed_cause_is_recoded(spark, raw):
    spellings = {s: cause for cause, listed in v.CAUSE_GROUPS.items() for s in listed}
    assert len({s.lower() for s in spellings}) == 48
    base = raw()
    many = spark.createDataFrame([(s,) for s in spellings], "causa_acidente string").join(
        base.drop("causa_acidente")
    )
    got = {r[0] for r in accidents.to_silver(many).select("causa_acidente").collect()}
    assert got == set(v.CAUSE_GROUPS)


@pytest.mark.parametrize(
    "given, reference, clean",
    [
        ("Nevoeiro/Neblina", "nublado", "nublado"),
        ("Ceu Claro", "céu claro", "céu claro"),
        ("Céu Claro", None, "céu claro"),
        ("Sol", None, "sol"),
        ("(null)", None, None),
    ],
)
def test_weather(raw, given, reference, clean):
    assert silver(raw, condicao_metereologica=given).condicao_metereologica == reference
    assert silver(raw, "clean", condicao_metereologica=given).condicao_metereologica == clean


@pytest.mark.parametrize(
    "given, reference, clean",
    [("1", "001", "001"), ("1234", "1234", "1234"), ("NA", "null", None), (None, "null", None)],
)
def test_highway(raw, given, reference, clean):
    assert silver(raw, br=given).br == reference
    assert silver(raw, "clean", br=given).br == clean


def test_unknown_fidelity(raw):
    with pytest.raises(ValueError):
        accidents.to_silver(raw(), "other")


def test_jobs_from_files_to_reports(spark, tmp_path):
    folder = tmp_path / "raw"
    folder.mkdir()
    deliver(
        folder, "2007.csv", LEAN,
        [accident(id=str(i), data_inversa="31/01/07", mortos="1") for i in range(3)],
    )
    deliver(folder, "2010.csv", v.RAW_COLUMNS, [accident(id="10", data_inversa="05/06/2010")])
    deliver(
        folder, "2017.csv", ["UOP", *[c for c in reversed(v.RAW_COLUMNS) if c != "uop"]],
        [accident(id="20", mortos="(null)"), accident(id="21", uf="(null)", mortos="2")],
    )
    lake = scratch_path(spark, "lake")

    def job(name, source, target, *more):
        jobs.run(spark, jobs.parse([name, source, f"{lake}/{target}", *more]))
        return f"{lake}/{target}"

    bronze = job("bronze", str(folder), "bronze")
    job("bronze", str(folder), "bronze")
    job("bronze", str(folder), "bronze", "--only-new")
    assert read_bronze(spark, bronze).count() == 6
    silver_path = job("silver", bronze, "silver")
    gold_path = job("gold", silver_path, "gold")
    gold = read_table(spark, gold_path)
    assert gold.columns == [*v.GOLD_KEYS, v.GOLD_COUNT, *v.GOLD_FLAGS, *v.GOLD_TOTALS]
    total, dead = gold.selectExpr("sum(QT_ACIDENTES)", "sum(QT_ACIDENTES_COM_MORTOS)").first()
    assert (total, dead) == (6, 4)
    assert gold.filter("QT_ACIDENTES_COM_MORTOS > QT_ACIDENTES").count() == 0

    yearly = read_table(spark, job("yearly", gold_path, "yearly"))
    assert yearly.dtypes == [
        ("ANO", "int"), ("QT_ACIDENTES_ANO", "bigint"), ("QT_PESSOAS", "bigint"),
        ("QT_MORTOS", "bigint"),
    ]
    assert sorted(tuple(r) for r in yearly.collect()) == [
        (2007, 3, 6, 3), (2010, 1, 2, 0), (2017, 2, 4, 2),
    ]

    profile = job("profile", str(folder), "profile")
    formats = read_table(spark, f"{profile}/formats")
    assert {r.value for r in formats.filter("column = 'data_inversa'").collect()} == {
        "DD/DD/DD", "DD/DD/DDDD", "DDDD-DD-DD",
    }
    assert read_table(spark, f"{profile}/values").filter("column = 'uf'").count() == 2
    columns = job("columns", str(folder), "columns")
    assert read_table(spark, f"{columns}/counts").filter("n_sources = 3").count() == len(LEAN)
    assert read_table(spark, f"{columns}/common").count() == len(LEAN)
    per_file = read_table(spark, f"{columns}/files")
    assert per_file.count() == len(LEAN) + 2 * len(v.RAW_COLUMNS)
    assert per_file.filter("position = 1 AND column = 'uop'").count() == 1

    (tmp_path / "roads.json").write_text(
        '{"features": [{"properties": {"vl_br": "101"}, "geometry":'
        ' {"type": "LineString", "coordinates": [[0, 1], [2, 3]]}}]}'
    )
    (tmp_path / "states.json").write_text(
        '{"objects": {"uf": {"geometries": [{"id": "SP"}, {"id": "MG"}]}}}'
    )
    report = read_table(
        spark,
        job(
            "report", gold_path, "report", "--highways", str(tmp_path / "roads.json"),
            "--states", str(tmp_path / "states.json"), "--years", "2007", "2010",
        ),
    )
    shown = {(r.panel, r.label): r.value for r in report.collect()}
    assert shown["cards", v.GOLD_COUNT] == "4"
    assert {panel for panel, _ in shown} >= {"state_map", "causes", "death_rates", "accidents_by_year"}
    assert read_table(spark, job("sample", bronze, "sample")).count() <= 6


def test_dashboard(spark):
    day = datetime.date
    gold = spark.createDataFrame(
        [
            (day(2007, 1, 1), "SP", "101", "a", "t1", 1500, 10, 5, 1),
            (day(2008, 1, 1), "MG", "116", "b", "t1", 1200, 10, 5, 0),
            (day(2008, 1, 1), "MG", "040", "b", "t2", 900, 0, 0, 0),
            (day(2009, 1, 1), None, None, None, "t3", 5, 1, 1, 1),
        ],
        "DATA date, SG_UF string, DS_BR string, DS_CAUSA string, DS_TIPO string,"
        "QT_ACIDENTES bigint, QT_TOTAL_PESSOAS bigint, QT_TOTAL_FERIDOS bigint,"
        "QT_TOTAL_MORTOS bigint",
    )
    highways = spark.createDataFrame([("101",), ("116",), ("040",)], "vl_br string")
    states = spark.createDataFrame([("SP",), ("MG",)], "id string")

    def show(**selected):
        with cached(gold) as kept:
            panels = accidents.dashboard(kept, highways, states, **selected)
            return {name: [tuple(r) for r in df.collect()] for name, df in panels.items()}

    panels = show()
    assert panels["cards"] == [(3605, 21, 11, 2)]
    assert panels["highway_table"] == [("101", 1500, 6, "1,500"), ("116", 1200, 1, "1,200")]
    assert [r[1:] for r in panels["highway_legend"]] == [
        (1200.0, "1 mil"), (1250.0, "1 mil"), (1300.0, "1 mil"), (1350.0, "1 mil"),
        (1400.0, "1 mil"), (1450.0, "1 mil"), (1500.0, "1 mil"),
    ]
    assert sorted(r[-1] for r in panels["state_map"]) == [1, 256]
    assert panels["state_table"] == [("MG", 2100, 256, "2,100"), ("SP", 1500, 1, "1,500")]
    assert [r[:2] for r in panels["causes"]] == [("b", 2100), ("a", 1500), ("Outros", 0)]
    assert panels["death_rates"] == [
        ("t3", 1.0, "100.0%"), ("t1", 0.05, "5.0%"), ("t2", None, None),
    ]
    assert panels["accidents_by_year"] == [
        (2008, 2100, True, "2.1"), (2007, 1500, False, "1.5"), (2009, 5, False, "0.0"),
    ]
    chosen = show(years=(2008, 2009), states=["MG"])
    assert chosen["cards"] == [(2100, 10, 5, 0)]
    assert [tuple(r) for r in accidents.choices(gold).filter("column = 'SG_UF'").collect()]
