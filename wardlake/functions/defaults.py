"""Names, lookup tables, word lists and patterns the results depend on.

Every one of them is the default of a parameter, so a caller can pass another.
"""

# --- Sentinels -----------------------------------------------------------------------
UNKNOWN = "Não informado"
UNKNOWN_CODE = "0000000"
OTHER_GROUP = "Outros"
UNKNOWN_AGE_KEY = -1

# --- Delimited files: texts that stand for a missing value ---------------------------
NULL_MARKERS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

# --- Spelling of letters and signs that have no ASCII part ----------------------------
SPELLINGS = {
    "ß": "ss", "æ": "ae", "œ": "oe", "ø": "o", "đ": "d", "ð": "d", "ħ": "h", "ı": "i", "ł": "l",
    "þ": "th", "ŋ": "ng", "–": "-", "—": "-", "‐": "-", "‑": "-", "−": "-", "‘": "'", "’": "'",
    "“": '"', "”": '"', "«": "<<", "»": ">>", "…": "...", "ª": "a", "º": "o", "°": "deg", "€": "EUR",
}

# --- Admission headers (compared without case and accents) ---------------------------
ADMISSION_ALIASES = {
    "data_internacao": "data_internacao",
    "data da internação": "data_internacao",
    "especialidade_hospitalar": "especialidade_hospitalar",
    "especialidade hospitalar": "especialidade_hospitalar",
    "especialidade": "especialidade_hospitalar",
    "numero_internacoes": "numero_internacoes",
    "número de internações": "numero_internacoes",
    "municipio_residencia": "municipio_residencia",
    "município de residência": "municipio_residencia",
    "município": "municipio_residencia",
    "idade": "idade",
    "sexo_paciente": "sexo_paciente",
    "sexo do paciente": "sexo_paciente",
    "sexo": "sexo_paciente",
}

# --- Specialties ---------------------------------------------------------------------
SPECIALTY_NAMES = {
    "CLINICA MEDICA": "Clínica Médica",
    "Clinica Medica": "Clínica Médica",
    "CIRURGIA GERAL": "Cirurgia Geral",
    "PEDIATRIA": "Pediatria",
    "OBSTETRICIA": "Obstetrícia",
    "ORTOPEDIA": "Ortopedia",
    "CARDIOLOGIA": "Cardiologia",
    "NEUROLOGIA": "Neurologia",
    "UTI": "UTI",
    "INFECTOLOGIA": "Infectologia",
}
SPECIALTY_GROUPS = {
    "Clínica Médica": "Clínico",
    "Cirurgia Geral": "Cirúrgico",
    "Pediatria": "Pediatria",
    "Obstetrícia": "Obstetrícia",
    "Ortopedia": "Ortopedia",
    "Cardiologia": "Clínico",
    "Neurologia": "Clínico",
    "UTI": "Terapia Intensiva",
    "Infectologia": "Clínico",
}

# --- Patient profile -----------------------------------------------------------------
AGE_BANDS = ((17, "0-17"), (39, "18-39"), (59, "40-59"))
OLDEST_BAND = "60+"
SEX_CODES = {
    "Masculino": ("M", "MASCULINO", "1"),
    "Feminino": ("F", "FEMININO", "2"),
}

# --- Places and calendar -------------------------------------------------------------
CAPITAL_PATTERN = "natal"
CAPITAL, INTERIOR = "Capital", "Interior"
STATE = "RN"
STUDY_YEARS = (2024, 2025)
DATE_FORMATS = ("yyyy-MM-dd", "dd/MM/yyyy", "yyyy/MM/dd", "yyyyMMdd")
# A time of day after a date, with or without seconds, fraction and offset.
TIME_OF_DAY = r"[T ]([01][0-9]|2[0-3]):[0-5][0-9](:[0-5][0-9]([.,][0-9]{1,9})?)?( ?(Z|[+-][0-9]{2}(:?[0-9]{2})?))?"
MONTH_NAMES = (
    "Janeiro", "Fevereiro", "Março", "Abril", "Maio", "Junho",
    "Julho", "Agosto", "Setembro", "Outubro", "Novembro", "Dezembro",
)
SEASONS = {"Verão": (12, 1, 2), "Outono": (3, 4, 5), "Inverno": (6, 7, 8)}
LAST_SEASON = "Primavera"

# --- The staging tables: column, type, and whether a value is required ------------------
ADMISSION_TABLE = (
    ("data_internacao", "date", True),
    ("especialidade_hospitalar", "string", False),
    ("especialidade_padrao", "string", True),
    ("grupo_especialidade", "string", False),
    ("numero_internacoes", "int", True),
    ("municipio_residencia", "string", True),
    ("codigo_municipio_ibge", "string", False),
    ("idade", "int", False),
    ("faixa_etaria", "string", True),
    ("sexo", "string", True),
    ("ano", "int", True),
    ("mes", "int", True),
    ("ano_mes", "string", True),
    ("trimestre", "int", True),
    ("capital_interior", "string", True),
)
COMMENT_TABLE = (
    ("comment_id", "string", True),
    ("post_id", "string", False),
    ("autor", "string", False),
    ("data_comentario", "date", False),
    ("curtidas", "int", False),
    ("texto_original", "string", False),
    ("texto_limpo", "string", False),
    ("sentimento", "string", True),
    ("score_sentimento", "decimal(6,3)", False),
    ("tokens", "string", False),
    ("qtd_tokens", "int", False),
)

# --- Sentiment -----------------------------------------------------------------------
POSITIVE_WORDS = (
    "excelente", "bom", "boa", "otimo", "ótimo", "parabens", "parabéns", "obrigada", "obrigado",
    "gratidao", "gratidão", "recomendo", "humanizado", "atenciosa", "competente", "qualidade",
    "impecavel", "impecável", "eficiente", "dedicados", "salvou", "melhor", "referencia", "referência",
)
NEGATIVE_WORDS = (
    "pessima", "péssima", "horrivel", "horrível", "ruim", "demora", "lento", "falta", "nunca",
    "desorganizacao", "desorganização", "fila", "enorme", "atraso", "limpeza",
)
NEGATED_PHRASES = ("nao gostei", "não gostei")
NEGATED_WEIGHT = 2
NEUTRAL_PHRASE = "nem bom nem ruim"
NEUTRAL_TOKEN = "normal"
POSITIVE, NEGATIVE, NEUTRAL = "positivo", "negativo", "neutro"
SCORE_THRESHOLD = 0.15
DIGEST_TOKENS = 30
MIN_TEXT_LENGTH = 3
SUMMARY_LENGTH = 200

# --- Terms ---------------------------------------------------------------------------
TFIDF_TERMS = 15
TFIDF_EXTRA_STOPWORDS = ("que", "mas", "com", "para", "uma", "muito")
COUNT_TERMS = 45
COUNT_STOPWORDS = ("que", "mas", "com", "para", "uma", "muito", "mais", "sobre", "este", "essa")

# --- Character classes shared by every text rule -------------------------------------
# Word: letters, numbers and underscore of any script. The ASCII ranges come first only
# because they are tested fastest. Space: everything Unicode counts as white space.
WORD = r"a-zA-Z0-9_\p{L}\p{N}"
SPACE = r"\x09-\x0d\x1c-\x20\x85\p{Z}"
# The same white space as characters, for trimming.
SPACE_CHARS = "".join(
    map(
        chr,
        [*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680,
         *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000],
    )
)
