"""Ordered buckets: the first step whose bound lies above the value wins, the rest is the top bucket.

A null value matches no step and so lands in the top bucket.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F

# Upper bounds (exclusive) and labels.
AMOUNT_RANGE = [(50, "MICRO"), (200, "SMALL"), (1000, "MEDIUM"), (5000, "LARGE"), (None, "VERY_LARGE")]
SCORE_CATEGORY = [(30, "LOW"), (60, "MEDIUM"), (80, "HIGH"), (None, "CRITICAL")]
INCOME_BAND = [
    (2000, "UP_TO_2K"), (5000, "2K_TO_5K"), (10000, "5K_TO_10K"), (20000, "10K_TO_20K"), (None, "ABOVE_20K"),
]
CREDIT_BAND = [(400, "VERY_LOW"), (500, "LOW"), (650, "MEDIUM"), (750, "GOOD"), (None, "EXCELLENT")]

# Hours (inclusive) of each part of the day; any other hour is night.
PERIODS = [(6, 11, "MORNING"), (12, 17, "AFTERNOON"), (18, 22, "EVENING")]

# Portuguese labels of the same buckets.
PT_LABELS = {
    "MORNING": "MANHA", "AFTERNOON": "TARDE", "EVENING": "NOITE", "NIGHT": "MADRUGADA",
    "MICRO": "MICRO", "SMALL": "PEQUENO", "MEDIUM": "MEDIO", "LARGE": "GRANDE", "VERY_LARGE": "MUITO_GRANDE",
    "UP_TO_2K": "ATÉ 2 SM", "2K_TO_5K": "2-5 SM", "5K_TO_10K": "5-10 SM", "10K_TO_20K": "10-20 SM",
    "ABOVE_20K": "ACIMA 20 SM",
    "VERY_LOW": "MUITO_BAIXO", "LOW": "BAIXO", "GOOD": "BOM", "EXCELLENT": "EXCELENTE",
    "UNUSUAL_TIME": "HORARIO_INCOMUM", "NEW_BENEFICIARY": "NOVO_BENEFICIARIO", "HIGH_RISK_MCC": "MCC_RISCO",
    "PENDING": "PENDENTE", "WEEKEND": "Fim de Semana", "WEEKDAY": "Dia Útil",
}
PT_TWO_RULE_LEVELS = {"HIGH": "Alto Risco", "MEDIUM": "Risco Médio", "LOW": "Baixo Risco"}
PT_LEVELS = {"CRITICAL": "CRÍTICO", "HIGH": "ALTO", "MEDIUM": "MÉDIO", "LOW": "BAIXO", "NORMAL": "NORMAL"}

# Reading order of the labels in reports.
LEVEL_ORDER = ["CRITICAL", "HIGH", "MEDIUM", "LOW", "NORMAL"]
PERIOD_ORDER = ["NIGHT", "MORNING", "AFTERNOON", "EVENING"]
RANGE_ORDER = ["MICRO", "SMALL", "MEDIUM", "LARGE", "VERY_LARGE"]


def bucket(value: Column, steps: list[tuple]) -> Column:
    *bounded, (_, top) = steps
    out = None
    for bound, label in bounded:
        out = F.when(value < bound, label) if out is None else out.when(value < bound, label)
    return out.otherwise(top)


def period_of_day(hour: Column) -> Column:
    out = None
    for start, end, label in PERIODS:
        hit = hour.between(start, end)
        out = F.when(hit, label) if out is None else out.when(hit, label)
    return out.otherwise("NIGHT")


def floor_level(score: Column, steps: list[tuple[int, str]], lowest: str) -> Column:
    """Highest level whose lower bound (inclusive) the score reaches; a null score gets the lowest."""
    out = None
    for bound, label in steps:
        out = F.when(score >= bound, label) if out is None else out.when(score >= bound, label)
    return out.otherwise(lowest)


def rank_of(label: Column, order: list[str]) -> Column:
    """Position of a label in a reading order, for sorting; an unknown label sorts last."""
    out = None
    for place, name in enumerate(order, start=1):
        out = F.when(label == name, place) if out is None else out.when(label == name, place)
    return out.otherwise(len(order) + 1)


def relabel(label: Column, names: dict[str, str] = PT_LABELS) -> Column:
    """Translate labels; a label without translation is kept."""
    out = None
    for name, other in names.items():
        if name != other:
            out = F.when(label == name, other) if out is None else out.when(label == name, other)
    return out.otherwise(label)
