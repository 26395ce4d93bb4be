"""Settings for a table of graduates: columns, rules, derived columns and texts."""

from __future__ import annotations

from tabulon.functions.expr import col
from tabulon.operators.features import (
    Derived, equals_flag, offset, ratio_plus_one, year_gap)
from tabulon.operators.score import HistoricalStats, ScoreNames
from tabulon.operators.validate import RowRules

# Column names and roles.
TARGET = "PROMEDIO_FINAL"
EXCLUDED = ("FECHA_CORTE", "UUID", "FECHA_EGRESO", "SITUACION_ALUMNO", "MODALIDAD")
STRATA = "NIVEL_ACADEMICO"
CATEGORICAL = ("NIVEL_ACADEMICO", "FACULTAD", "PROGRAMA_ESTUDIOS", "SITUACIÓN ALUMNO", "SEDE",
               "SEXO", "SEMESTRE_EGRESO", "DETALLE_TIPO_ESTUDIO")
NUMERIC = ("ANNIO_EGRESO", "CREDITOS_ACUMULADOS", "ANNIO_MATRICULA1",
           "ANNIO_SOLICITUD_TRAMITE")

# History of the target.
HISTORY = HistoricalStats(mean=15.96, std=1.15, low=12.23, high=19.30)
BATCH_NAMES = ScoreNames("PROMEDIO_PREDICHO", "LIMITE_INFERIOR", "LIMITE_SUPERIOR")

# Labels of a prediction, from low to high.
INTERPRETATION = (
    "Bajo - Por debajo del promedio histórico",
    "Regular - Cerca del promedio",
    "Bueno - Por encima del promedio",
    "Excelente - Por encima del promedio histórico",
)
REQUEST_INTERPRETATION = (
    "Rendimiento académico por debajo del promedio. Se recomienda apoyo adicional.",
    "Rendimiento académico aceptable. Hay oportunidades de mejora.",
    "Rendimiento académico satisfactorio. El estudiante está cerca del promedio.",
    "Buen rendimiento académico. El estudiante está por encima del promedio.",
    "Excelente rendimiento académico. El estudiante está en el tercio superior.",
)

# What a scoring request must satisfy.
REQUEST_RULES = RowRules(
    text=("FACULTAD", "PROGRAMA_ESTUDIOS", "SEDE", "SEXO", "NIVEL_ACADEMICO",
          "DETALLE_TIPO_ESTUDIO"),
    numeric=("ANNIO_EGRESO", "CREDITOS_ACUMULADOS", "ANNIO_MATRICULA1",
             "ANNIO_SOLICITUD_TRAMITE", "SEMESTRE_EGRESO"),
    ranges=(("ANNIO_EGRESO", 2020, 2030), ("CREDITOS_ACUMULADOS", 0, 300)),
    ordered=(("ANNIO_MATRICULA1", "ANNIO_EGRESO"),),
)

DERIVED = (
    Derived("DURACION_ESTUDIOS", ("ANNIO_EGRESO", "ANNIO_MATRICULA1"),
            lambda: year_gap(col("ANNIO_EGRESO"), col("ANNIO_MATRICULA1"), 0, 15),
            "years from first enrolment to graduation"),
    Derived("ANNIO_EGRESO_NORM", ("ANNIO_EGRESO",),
            lambda: offset(col("ANNIO_EGRESO"), 2020), "graduation year from 2020"),
    Derived("CREDITOS_POR_ANNIO", ("CREDITOS_ACUMULADOS", "DURACION_ESTUDIOS"),
            lambda: ratio_plus_one(col("CREDITOS_ACUMULADOS"), col("DURACION_ESTUDIOS")),
            "credits per year of study"),
    Derived("ES_POSTGRADO", ("NIVEL_ACADEMICO",),
            lambda: equals_flag(col("NIVEL_ACADEMICO"), "POSGRADO"), "postgraduate"),
    Derived("SEXO_BIN", ("SEXO",), lambda: equals_flag(col("SEXO"), "F"), "female"),
    Derived("TIEMPO_TRAMITE", ("ANNIO_SOLICITUD_TRAMITE", "ANNIO_EGRESO"),
            lambda: year_gap(col("ANNIO_SOLICITUD_TRAMITE"), col("ANNIO_EGRESO"), 0, 10),
            "years from graduation to request"),
    Derived("ES_REGULAR", ("DETALLE_TIPO_ESTUDIO",),
            lambda: equals_flag(col("DETALLE_TIPO_ESTUDIO"), "REGULAR"), "regular study"),
)
