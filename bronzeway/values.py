"""Fixed values of the published accident data and its reports.

Results depend on these word lists, names and formats; they are plain data and
hold no logic.
"""

# ---------------------------------------------------------------------------
# Source files
# ---------------------------------------------------------------------------

CSV_OPTIONS = {"header": "true", "sep": ";", "encoding": "ISO-8859-1"}

SOURCE_COLUMN = "source_filename"

RAW_COLUMNS = [
    "id", "data_inversa", "dia_semana", "horario", "uf", "br", "km", "municipio",
    "causa_acidente", "tipo_acidente", "classificacao_acidente", "fase_dia",
    "sentido_via", "condicao_metereologica", "tipo_pista", "tracado_via", "uso_solo",
    "pessoas", "mortos", "feridos_leves", "feridos_graves", "ilesos", "ignorados",
    "feridos", "veiculos", "latitude", "longitude", "regional", "delegacia", "uop",
]

# The last three are not carried on.
SILVER_SOURCE_COLUMNS = RAW_COLUMNS[:-3]

# ---------------------------------------------------------------------------
# Cleaning
# ---------------------------------------------------------------------------

NULL_TOKENS = ["(null)", "NA", "N/A", "null", "na", "n/a"]

DATE_SHAPES = [("____-%", "yyyy-MM-dd"), ("%/%/__", "dd/MM/yy")]
DATE_OTHERWISE = "dd/MM/yyyy"

WEEKDAY_SUFFIX = "-feira"

HIGHWAY_WIDTH = 3

CLASSIFICATION_FILL = "Ignorado"
LAYOUT_FILL = "Não Informado"

FLOAT_COLUMNS = ["km", "latitude", "longitude"]

COUNT_COLUMNS = [
    "pessoas", "mortos", "feridos_leves", "feridos_graves", "ilesos", "feridos",
    "ignorados", "veiculos",
]

# Cleaned of null tokens only.
TOKEN_ONLY_COLUMNS = ["uf", "tipo_pista", "uso_solo"]

CAUSES_TO_NULL = ["outras"]

# Published cause and the spellings it stands for; compared in lower case.
CAUSE_GROUPS = {
    "Falta de atenção": [
        "Falta de atenção",
        "Falta de Atenção à Condução",
    ],
    "Ingestão de álcool ou psicoativos": [
        "Ingestão de substâncias psicoativas pelo condutor",
        "Ingestão de álcool pelo condutor",
        "Ingestão de álcool",
        "Ingestão de Substâncias Psicoativas",
        "Ingestão de Álcool",
    ],
    "Não guardar distância de segurança": [
        "Não guardar distância de segurança",
        "Condutor deixou de manter distância do veículo da frente",
    ],
    "Defeito Mecânico no Veículo": [
        "Problema com o freio",
        "Problema na suspensão",
        "Defeito mecânico em veículo",
        "Avarias e/ou desgaste excessivo no pneu",
        "Defeito Mecânico no Veículo",
        "Demais falhas mecânicas ou elétricas",
        "Faróis desregulados",
        "Deficiência ou não Acionamento do Sistema de Iluminação/Sinalização do Veículo",
    ],
    "Defeito na via": [
        "Demais falhas na via",
        "Defeito na via",
        "Defeito na Via",
        "Pista esburacada",
        "Falta de acostamento",
        "Afundamento ou ondulação no pavimento",
        "Falta de elemento de contenção que evite a saída do leito carroçável",
    ],
    "Condutor dormindo": [
        "Dormindo",
        "Condutor Dormindo",
    ],
    "Desobediência à sinalização": [
        "Desobediência à sinalização",
        "Condutor desrespeitou a iluminação vermelha do semáforo",
    ],
    "Desobediência às normas de trânsito pelo condutor": [
        "Desobediência às normas de trânsito pelo condutor",
        "Desrespeitar a preferência no cruzamento",
    ],
    "Mal Súbito": [
        "Mal Súbito",
        "Mal súbito do condutor",
    ],
    "Reação tardia ou ineficiente do condutor": [
        "Reação tardia ou ineficiente do condutor",
        "Ausência de reação do condutor",
    ],
    "Fenômenos da Natureza": [
        "Fenômenos da Natureza",
        "Demais Fenômenos da natureza",
        "Chuva",
        "Neblina",
        "Fumaça",
    ],
    "Desobediência às normas de trânsito pelo pedestre": [
        "Pedestre andava na pista",
        "Entrada inopinada do pedestre",
        "Desobediência às normas de trânsito pelo pedestre",
        "Pedestre cruzava a pista fora da faixa",
    ],
    "Ingestão de álcool ou psicoativos pelo pedestre": [
        "Ingestão de álcool ou de substâncias psicoativas pelo pedestre",
        "Ingestão de álcool e/ou substâncias psicoativas pelo pedestre",
    ],
    "Transitar no acostamento": [
        "Transitar no acostamento",
        "Transitar na calçada",
    ],
    "Acumulo de material sobre o pavimento": [
        "Acumulo de areia ou detritos sobre o pavimento",
        "Acumulo de óleo sobre o pavimento",
        "Acumulo de água sobre o pavimento",
    ],
}

# Accident types in lower case; the first fitting rule wins.
TYPE_RULES = [
    ("contains", ["colisão", "objeto"], "colisão com objeto"),
    ("contains", ["queda"], "queda do veiculo"),
    ("swap", "pedestre", "pessoa"),
    ("equals", "saída de leito carroçável", "saída de pista"),
]

WEATHER_GROUPS = {"nevoeiro/neblina": "nublado", "ceu claro": "céu claro"}

# ---------------------------------------------------------------------------
# Gold table: published name and silver column
# ---------------------------------------------------------------------------

GOLD_KEYS = {
    "DATA": "date",
    "DS_DIA_SEMANA": "dia_semana",
    "DS_FASE_DIA": "fase_dia",
    "DS_CONDICAO_METEREOLOGICA": "condicao_metereologica",
    "SG_UF": "uf",
    "DS_BR": "br",
    "DS_CAUSA": "causa_acidente",
    "DS_TIPO": "tipo_acidente",
}

GOLD_COUNT = "QT_ACIDENTES"

GOLD_FLAGS = {
    "QT_ACIDENTES_COM_MORTOS": "mortos",
    "QT_ACIDENTES_COM_FERIDOS": "feridos",
    "QT_ACIDENTES_COM_FERIDOS_LEVES": "feridos_leves",
    "QT_ACIDENTES_COM_FERIDOS_GRAVES": "feridos_graves",
}

GOLD_TOTALS = {
    "QT_TOTAL_PESSOAS": "pessoas",
    "QT_TOTAL_ILESOS": "ilesos",
    "QT_TOTAL_FERIDOS": "feridos",
    "QT_TOTAL_FERIDOS_LEVES": "feridos_leves",
    "QT_TOTAL_FERIDOS_GRAVES": "feridos_graves",
    "QT_TOTAL_MORTOS": "mortos",
    "QT_TOTAL_IGNORADOS": "ignorados",
}

# ---------------------------------------------------------------------------
# Checks, profiles and reports
# ---------------------------------------------------------------------------

YEAR = "ANO"

YEARLY_MEASURES = {
    "QT_ACIDENTES_ANO": "QT_ACIDENTES",
    "QT_PESSOAS": "QT_TOTAL_PESSOAS",
    "QT_MORTOS": "QT_TOTAL_MORTOS",
}

FORMAT_PROFILE_COLUMNS = ["data_inversa", "horario", "km", "latitude", "longitude", "br"]

VALUE_PROFILE_COLUMNS = [
    "dia_semana", "uf", "causa_acidente", "tipo_acidente", "classificacao_acidente",
    "fase_dia", "sentido_via", "condicao_metereologica", "tipo_pista", "tracado_via",
    "uso_solo", "regional",
]

PROFILE_ROWS = 200

SAMPLE_FRACTION, SAMPLE_SEED = 0.05, 214

CARD_MEASURES = ["QT_ACIDENTES", "QT_TOTAL_PESSOAS", "QT_TOTAL_FERIDOS", "QT_TOTAL_MORTOS"]

HIGHWAY_DIM_KEY, STATE_DIM_KEY = "vl_br", "id"

HIGHWAY_MIN_ACCIDENTS = 1000

COUNT_LABEL = "Qtd. Acidentes"

TOP_TABLE_ROWS, TOP_CAUSES, TOP_RATES = 15, 10, 10

OTHERS_LABEL = "Outros"

LABEL_WIDTH = 35

MAP_CLASSES, TABLE_CLASSES_HIGHWAY, TABLE_CLASSES_STATE = 6, 6, 256
STATE_MAP_CLASSES = 256
