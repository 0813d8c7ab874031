"""Fixed values of the default (Chilean news) configuration.

Nothing here is logic: other corpora pass their own lists to the operators.
"""

# General Spanish stop words, accent-free.
GENERAL_STOP_WORDS = """
a actualmente ademas ahi al algo algunas algunos ante antes aquel aquella
aquellas aquello aquellos aqui asi aunque ayer bajo bien cada casi como con
contra cual cuando cuenta da de debe debido del desde despues dia dias dice
dijo donde dos durante e el ella ellas ello ellos embargo en entre era es esa
esas ese eso esos esta estaba estado estan estar estas este esto estos fue
fueron ha habia han hasta hay hizo hoy la las le les lo los luego mas me
mediante menos mi mientras mis muy no nos nueva nuevas nuevo nuevos o otra
otras otro otros para parte pero poco por porque puede pueden que quien
quienes realizo se sea segun ser sera si sin sobre solo son su sus tambien
tanto te tener tiene tienen todo todos tras tu un una unas uno unos vez y ya
""".split()

# Stop words of the news domain.
DOMAIN_STOP_WORDS = """
abril agosto ano anos chile chilena chilenas chileno chilenos diciembre enero
febrero julio junio marzo mayo nacional noviembre octubre pais personas
septiembre
""".split()

STOP_WORDS = frozenset(GENERAL_STOP_WORDS) | frozenset(DOMAIN_STOP_WORDS)

# Region names in key order, keys start at 1, the last is "unknown".
REGION_NAMES = [
    "Arica y Parinacota",
    "Tarapaca",
    "Antofagasta",
    "Atacama",
    "Coquimbo",
    "Valparaiso",
    "Metropolitana",
    "Ohiggins",
    "Maule",
    "Nuble",
    "Biobio",
    "La Araucania",
    "Los Rios",
    "Los Lagos",
    "Aysen",
    "Magallanes",
    "Desconocida",
]
UNKNOWN_REGION = 17

# Aliases that vote for a region, by region key.
REGION_ALIASES = {
    1: ["arica", "parinacota"],
    2: ["tarapaca", "iquique", "alto hospicio"],
    3: ["antofagasta", "calama", "tocopilla"],
    4: ["atacama", "copiapo", "vallenar"],
    5: ["coquimbo", "la serena", "ovalle"],
    6: ["valparaiso", "vina del mar", "quilpue", "san antonio"],
    7: ["metropolitana", "santiago", "rm", "region metropolitana", "capital"],
    8: ["ohiggins", "rancagua", "san fernando"],
    9: ["maule", "talca", "curico", "linares"],
    10: ["nuble", "chillan"],
    11: ["biobio", "concepcion", "talcahuano", "los angeles"],
    12: ["araucania", "temuco"],
    13: ["los rios", "valdivia"],
    14: ["los lagos", "puerto montt", "osorno", "castro"],
    15: ["aysen", "coihaique", "coyhaique"],
    16: ["magallanes", "punta arenas"],
}

# Texts that stand in for missing fields.
PLACEHOLDERS = {
    "title": "sin titulo",
    "body": "sin cuerpo",
    "source": "fuente desconocida",
}

# CSV cell contents that count as missing (the pandas defaults).
NA_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
]

# Regions shown in the regional report unless others are named.
REPORT_REGIONS = [
    "Arica y Parinacota",
    "Biobio",
    "Metropolitana",
    "Tarapaca",
    "Valparaiso",
]
