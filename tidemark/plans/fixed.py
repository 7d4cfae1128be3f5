"""Fixed values of the flow: calendar, dictionaries, column contracts and published texts.

Names and texts here are part of the results and therefore kept as they are published.
"""

from tidemark.learning.features import FeatureSpec

# Academic calendar (period code, year, semester, semester ordinal, cohort, ordinal).
CALENDAR_SCHEMA = ("periodo_codigo string, anio int, semestre_academico string, "
                   "semestre_orden int, cohorte_tipo string, periodo_orden int")
CALENDAR = [
    ("periodo_1701", 2024, "2024-1", 1, "principal", 1),
    ("periodo_1702", 2024, "2024-1", 1, "secundaria", 2),
    ("periodo_1703", 2024, "2024-1", 1, "complementaria", 3),
    ("periodo_1704", 2024, "2024-2", 2, "principal", 4),
    ("periodo_1705", 2024, "2024-2", 2, "secundaria", 5),
    ("periodo_2031", 2025, "2025-1", 3, "principal", 6),
    ("periodo_2032", 2025, "2025-1", 3, "secundaria", 7),
    ("periodo_2033", 2025, "2025-1", 3, "complementaria", 8),
    ("periodo_2034", 2025, "2025-2", 4, "principal", 9),
    ("periodo_2035", 2025, "2025-2", 4, "secundaria", 10),
]
# Which cohort of a semester wins.
COHORT_PRIORITY = ("principal", "secundaria", "complementaria")

# Technical codes of the poverty register and their business names.
POVERTY_NAMES = {
    "cod_mpio": "municipio_codigo",
    "h_5": "indicador_pobreza_ipm",
    "i1": "priv_bajo_logro_educativo",
    "i2": "priv_analfabetismo",
    "i3": "priv_inasistencia_escolar",
    "i4": "priv_rezago_escolar",
    "i5": "priv_barreras_cuidado_infancia",
    "i6": "priv_trabajo_infantil",
    "i7": "priv_desempleo_larga_duracion",
    "i8": "priv_trabajo_informal",
    "i9": "priv_sin_aseguramiento_salud",
    "i10": "priv_barreras_acceso_salud",
    "i11": "priv_sin_acceso_agua_mejorada",
    "i12": "priv_eliminacion_excretas_inadecuada",
    "i13": "priv_material_pisos_inadecuado",
    "i14": "priv_material_paredes_inadecuado",
    "i15": "priv_hacinamiento_critico",
    "grupo": "sisben_grupo",
    "nivel": "sisben_nivel",
    "clasificacion": "sisben_clasificacion",
    "zona": "sisben_zona",
    "per001": "pers_sexo",
    "per002": "pers_edad",
    "per003": "pers_parentesco_jefe",
    "per004": "pers_estado_civil",
    "per007": "pers_seguridad_social",
    "per011": "pers_embarazada",
    "per015": "pers_sabe_leer_escribir",
    "per016": "pers_estudia_actualmente",
    "per017": "pers_nivel_educativo",
    "per018": "pers_cotiza_pension",
    "per019": "pers_actividad_principal_mes",
    "per020": "pers_posicion_ocupacional",
}

# Homologation of credit categories.
CREDIT_RULES = [
    ("%No recibi%", "No recibio credito"),
    ("%Largo%", "Largo plazo"),
    ("%Mediano%", "Mediano plazo"),
]

# Silver tables and the gold dimensions that mirror them.
MIRRORS = {
    "snies_graduados": "dim_gold_snies_graduados",
    "spadies_creditoicetex": "dim_gold_spadies_creditos",
    "gobierno_sisben_iv": "dim_gold_gobierno_sisben",
    "gobierno_internet_fijo": "dim_gold_gobierno_internet",
}

# Period files by name, and how residential segments begin.
PERIOD_FROM_FILE = r"estudiantes_([^/]+)\.csv"
RESIDENTIAL = "RESIDENCIAL"

# Columns of the modelling table.
SEMESTER_COLUMNS = [
    "id", "anio", "semestre_academico", "semestre_orden", "cohorte_tipo",
    "n_periodos_en_semestre", "edad", "sexo", "estrato_social", "zona_de_residencia",
    "escuela", "programa", "zona", "centro", "departamento_residencia", "municipio_residencia",
    "codigo_divipola", "tasa_informalidad_mpio", "tasa_hacinamiento_mpio", "promedio_ipm_mpio",
    "poblacion_sisben_mpio", "total_accesos_res", "nivel_conectividad",
    "anio_corte_conectividad", "semestres_cursados_acum", "gap_desde_semestre_anterior",
    "es_primer_semestre", "desertion_t1",
]

# Feature contract.
CHURN_SPEC = FeatureSpec(
    entity="id", period="semestre_orden", target="desertion_t1",
    numeric=("edad", "estrato_social", "n_periodos_en_semestre", "semestres_cursados_acum",
             "gap_desde_semestre_anterior", "es_primer_semestre", "tasa_informalidad_mpio",
             "tasa_hacinamiento_mpio", "promedio_ipm_mpio", "log_poblacion_sisben_mpio",
             "log_total_accesos_res", "nivel_conectividad"),
    categorical=("sexo", "zona_de_residencia", "escuela", "programa", "zona", "centro",
                 "departamento_residencia", "cohorte_tipo"),
    logs={"log_poblacion_sisben_mpio": "poblacion_sisben_mpio",
          "log_total_accesos_res": "total_accesos_res"},
    barred=("total_periodos_matriculados", "tasa_permanencia", "primer_periodo",
            "ultimo_periodo", "next_semestre_orden", "semestre_orden", "anio",
            "municipio_residencia"),
)

# Dimensions of the demographic table.
DEMOGRAPHIC_DIMS = ("sexo", "zona_de_residencia", "estrato_social", "nivel_conectividad")

# Categories pooled for the gap indicators.
STRATUM_LOW = ("0.0", "0", "1.0", "1")
STRATUM_HIGH = ("3.0", "3", "4.0", "4", "5.0", "5")
CONNECTIVITY_LOW = ("0.0", "0", "1.0", "1")
CONNECTIVITY_HIGH = ("3.0", "3")

# Label, unit and definition of each published indicator.
KPI_TEXTS = {
    "tasa_desercion": (
        "Tasa de deserción intersemestral", "%",
        "Estudiantes sin matrícula en el semestre siguiente / evaluables "
        "(excluye el último semestre, censurado)"),
    "tasa_retencion": (
        "Tasa de retención", "%", "100 - tasa de deserción intersemestral"),
    "matricula_ultimo_semestre": (
        "Matriculados último semestre", "", "Estudiantes únicos en {semestre}"),
    "brecha_estrato": (
        "Brecha por estrato (0-1 vs 3+)", "p.p.",
        "Diferencia de tasa de deserción entre estratos 0-1 y estratos 3 o más"),
    "brecha_conectividad": (
        "Brecha por conectividad (baja vs alta)", "p.p.",
        "Diferencia de tasa de deserción entre municipios de conectividad baja/nula y alta"),
    "riesgo_alto": (
        "Estudiantes en riesgo alto (semestre vigente)", "",
        "Score de riesgo >= umbral del modelo en el último semestre puntuado"),
    "f1_modelo": (
        "F1 del modelo (holdout)", "",
        "F1 de la clase deserción en el 20% de estudiantes nunca vistos"),
}
# Indicators without decimals, and the note in the manifest.
WHOLE_NUMBER_KPIS = ("matricula_ultimo_semestre", "riesgo_alto")
PRIVACY_NOTE = ("Todos los datos publicados son agregados disociados: celdas con menos de "
                "{min_cell} estudiantes suprimidas o colapsadas; tasas 0%/100% no publicadas.")

# Published names of the generic columns.
PUBLISHED_NAMES = {
    "enrolled": "matriculados", "evaluable": "evaluables", "churned": "desertores",
    "churn_pct": "tasa_desercion_pct", "low_confidence": "baja_confianza",
    "category": "categoria", "n_entities": "n_estudiantes", "n_high": "n_riesgo_alto",
    "mean_score": "prob_promedio", "high_pct": "pct_riesgo_alto",
}
