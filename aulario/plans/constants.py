"""Word lists, code tables, headings and sheet names the source data uses.

They must be stated as the spreadsheets and the target fields spell them.
"""

# --- null tokens -------------------------------------------------------------------------
EXCEL_ERRORS = ("#N/A", "#NA", "#DIV/0!", "#VALUE!", "#REF!", "#NAME?", "#NULL!", "#NUM!")
TEXT_NULLS = ("nan", "NaN", "None", "null", "", "NA")
GRADES_NULLS = ("nan", "None", "NaT", "")
UPPER_NULLS = ("NAN", "")
ID_NULLS = ("0",)

# --- attendance --------------------------------------------------------------------------
REGULAR_HEADER_ROW = 6
REGULAR_FIRST_COL = 2
EXTRA_REQUIRED_TITLES = ("DNI", "GRADO")
EXTRA_NAME_TITLES = ("APELLIDOS Y NOMBRES", "NOMBRES Y APELLIDOS", "NOMBRE COMPLETO")
TUTOR_LABEL = r"tutora?:"
# The regular sheets write M for mujer, the others M for masculino.
SEX_REGULAR = {"H": "MASCULINO", "MASCULINO": "MASCULINO", "F": "FEMENINO", "M": "FEMENINO", "FEMENINO": "FEMENINO"}
SEX_EXTRA = {"M": "MASCULINO", "F": "FEMENINO", "H": "MASCULINO"}
EXTRA_FILE_PREFIX = "TALLERES_"
EXTRA_FILE_SUFFIX = " REGISTRO DE ASISTENCIA {year}"
ATTENDANCE_COLUMNS = (
    "DNI", "NOMBRE", "CENTRO", "GRADO", "SEXO", "F_INCORPORACION", "TIPO_ALUMNO", "F_SALIDA",
    "ALERTAS_ASISTENCIA", "FECHA", "ASISTENCIA", "A_ESPERADAS", "A_REALES", "PORC_PART",
    "ARCHIVO_ORIGEN", "HOJA_ORIGEN", "TUTOR",
)

# --- enrolment ---------------------------------------------------------------------------
ENROLMENT_HEADER_ROW = 4
ENROLMENT_FIRST_COL = 2
GRADE_NAMES = {
    "00 INICIAL": "INICIAL", "1ER GRADO": "PRIMERO", "2DO GRADO": "SEGUNDO", "3ER GRADO": "TERCERO",
    "4TO GRADO": "CUARTO", "5TO GRADO": "QUINTO", "6TO GRADO": "SEXTO",
}
SEX_ENROLMENT = {"M": "MASCULINO", "HOMBRE": "MASCULINO", "F": "FEMENINO", "MUJER": "FEMENINO"}
MONTH_WORDS = {
    "enero": 1, "febrero": 2, "marzo": 3, "abr": 4, "mayo": 5, "junio": 6, "julio": 7, "agosto": 8,
    "septiembre": 9, "octubre": 10, "noviembre": 11, "diciembre": 12,
}
MONTH_WORDINGS = {"set24": "2024-09-01", "abr - ago": "{year}-04-01"}

# --- grades ------------------------------------------------------------------------------
GRADE_SHEETS = (
    ("LB_Matemática", "Matemática", "LB"),
    ("LS_Matemática", "Matemática", "LS"),
    ("LB_Comunicación", "Comunicación", "LB"),
    ("LS_Comunicación", "Comunicación", "LS"),
    ("LB_Socioemocional", "Socioemocional", "LB"),
    ("LS_Socioemocional", "Socioemocional", "LS"),
    ("LB_Tecnología", "Tecnología", "LB"),
    ("LS_Tecnología", "Tecnología", "LS"),
    ("LB_Ciencias", "Ciencias", "LB"),
    ("LS_Ciencias", "Ciencias", "LS"),
)
YEAR_HEADING = "PERMANENCIA"
SCORE_HEADING = r"PROMEDIO\s*C\d+"
LEVEL_HEADING = r"NIVEL DE LOGRO\s*C\d+"
EQUIVALENCE_HEADINGS = {"Área": "AREA_EVALUACION", "Equivalencia": "COMPETENCIA", "Competencia": "COMPETENCIA_TEXTO"}

# --- forms -------------------------------------------------------------------------------
STAMP = "Marca temporal"
SURVEY_RENAMES = {
    "Documento de identidad": "Documento de identidad Apoderado",
    "Documento de identidad ": "Documento de identidad Niño",
    "N° de documento": "N Documento Apoderado",
    "N° de documento ": "N Documento Niño",
}
SURVEY_KEY = "N Documento Apoderado"
SOCIAL_KEY = "Número de documento del niño"
REQUEST_KEY = "Número de Documento"
REQUEST_OTHER_IDS = ("Número de Documento.1", "Número de celular")
REQUEST_BIRTH = "Fecha de nacimiento"
DISABILITY = "¿Qué discapacidad tiene?"
DISABILITY_WHOLE = {"NINGUNA": ("NADA", "NINGUNA", "NINGUNO")}
DISABILITY_WORDS = {
    "LENGUAJE": ("LENGUAJE",),
    "APRENDIZAJE": ("RETARDO", "APRENDISAJE", "TDH", "FRONTERIZO"),
    "TEA": ("AUTISMO",),
    "VISUAL": ("VISION", "ASTIGMATISMO", "VISTA"),
    "FISICA": ("DISPLACIA", "MICROTIA", "CADERA"),
}
DISABILITY_OTHER = "OTRO"

# --- curriculum --------------------------------------------------------------------------
CURRICULUM_SHEETS = {
    2025: (
        "01 Pachacutec", "02 HDMP", "03 Santa Rosa", "04 Pte Piedra", "05 Cuzco",
        "06 Huancavelica - IE 36003", "07 Huarochiri", "08 VMT Paraíso", "09 Huancavelica - IE 36002",
    ),
    2026: (
        "01 Pachacutec", "02 HDMP", "03 Santa Rosa", "04 Pte Piedra", "05 Cuzco",
        "06 Huancavelica - IE 36003", "07 Huarochiri", "08 VMT Paraíso", "09 Huancavelica - IE 36002",
        "10 SJM - Pamplona", "11 Huancayo - IE N° 31545",
    ),
}
CURRICULUM_DROP = ("CAPACIDAD",)

# --- timetable hours ---------------------------------------------------------------------
HOURS_SHEET = "Distribución horaria"
HOURS_SITES = ("VENTANILLA", "PUENTE PIEDRA", "CUSCO", "HUANCAVELICA", "HUAROCHIRÍ", "VMT - PARAISO")
HOURS_FIRST_ROW = 5
HOURS_SKIPPED_ROWS = (61, 72)
HOURS_CYCLES = {"CICLO_II": 2, "CICLO_III": 3, "CICLO_IV": 4, "CICLO_V": 5}
HOURS_CONCEPT_COL = 1
HOURS_VARIABLES = "VARIABLES"
HOURS_PREFIX = "N° HORAS SEMANALES"
HOURS_AREA_PREFIX = "N° HORAS SEMANALES |"
GRADE_PAIRS = {
    "INICIAL": ("INICIAL",),
    "1ER Y 2DO GRADO": ("1ER GRADO", "2DO GRADO"),
    "3ER Y 4TO GRADO": ("3ER GRADO", "4TO GRADO"),
    "5TO Y 6TO GRADO": ("5TO GRADO", "6TO GRADO"),
}
SPLIT_SITE = "VENTANILLA"
SPLIT_SITES = ("01 PACHACUTEC", "02 HDMP", "03 SANTA ROSA")
SITE_CODES = {
    "PUENTE PIEDRA": "04 PTE. PIEDRA", "CUSCO": "05 CUSCO", "HUANCAVELICA": "06 HUANCAVELICA",
    "HUAROCHIRI": "07 HUAROCHIRI", "VMT - PARAISO": "08 VMT PARAISO",
}
WEEKS_PER_BIMESTER = 8
BIMESTERS = {
    "01 PACHACUTEC": 4.0, "02 HDMP": 4.0, "03 SANTA ROSA": 4.0, "04 PTE. PIEDRA": 4.5, "05 CUSCO": 4.5,
    "06 HUANCAVELICA": 4.5, "07 HUAROCHIRI": 4.5, "08 VMT PARAISO": 4.5,
}

# --- experiential activities -------------------------------------------------------------
EXPERIENTIAL_SHEET = "H4 Registro niños"
EXPERIENTIAL_ACTIVITY_ROW, EXPERIENTIAL_DATE_ROW = 2, 3
EXPERIENTIAL_ID_COLS = {
    "DNI": 1, "NOMBRES Y APELLIDOS": 2, "GRADO": 3, "SEXO": 4, "CENTRO": 5, "ESTADO": 6,
}
EXPERIENTIAL_TOTALS = ("ASISTENCIAS PROGRAMADAS", "ASISTENCIAS REALES", "% PART.", "CONDICIÓN DE PARTICIPACIÓN")

# --- skills ------------------------------------------------------------------------------
SKILL_SHEETS = {"H_Autogestión": "Autogestión", "H_Sociales": "Sociales", "H_Investigación": "Investigación"}
SKILL_COLUMNS = {
    "DNI": "DNI__c",
    "Apellidos y nombres": "Apellidos_y_nombres__c",
    "Grado": "Grado__c",
    "Sexo": "Sexo__c",
    "Centro": "Centro__c",
    "Permanencia": "Permanencia__c",
    "Condicion actual": "Condicin_actual__c",
    "Habilidades": "Habilidades__c",
}
SKILL_LEVELS = {"Nivel de logro Base": "LB", "Nivel de logro Salida": "LS"}
LEVEL_ORDER = {"en inicio": 1, "en proceso": 2, "logrado": 3, "sobresaliente": 4}

# --- dashboard ---------------------------------------------------------------------------
AGREEMENT = {"MUY EN DESACUERDO": 1, "EN DESACUERDO": 2, "DE ACUERDO": 3, "MUY DE ACUERDO": 4}
NO_ANSWER = "Sin respuesta"
SLICER_ROWS = {
    "impactados": "N° de niños(as) impactados",
    "activos": "N° niños activos",
    "inactivos": "N° niños inactivos",
}
KPI_TARGETS = {
    "children_total": 1000.0,
    "retention_rate": 0.85,
    "mean_attendance": 0.80,
    "level_share": 0.70,
    "child_satisfaction": 3.5,
    "skill_share": 0.60,
}
