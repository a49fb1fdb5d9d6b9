"""Settings of a run: the calendar, the roles of columns and the thresholds of the rules."""
from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Config:
    #: First month that isn't closed, as year * 12 + month - 1, and the closed months kept for the exam.
    current: int = 2000 * 12 + 9
    test_months: int = 3
    one_year: str = "1 year"
    mandatory: tuple[str, ...] = ("region", "product")
    negative: tuple[str, ...] = ("dormant", "softcancel")
    positive: tuple[str, ...] = ("autorenew",)
    extra: tuple[str, ...] = ("channel",)
    bucket_edges: tuple[int, ...] = (0, 10, 20, 30, 40, 100)
    support_floor: int = 30
    support_full: int = 271
    #: Credibility: fewer siblings than this take the default k; too little spread between them takes the largest.
    least_siblings: int = 3
    default_k: float = 60.0
    largest_k: float = 600.0
    z90: float = 1.645
    margin_short: float = 0.10
    least_history: int = 12

    @property
    def series(self) -> tuple[str, ...]:
        return self.mandatory + self.negative + self.positive + self.extra

    @property
    def exam(self) -> int:
        return self.current - self.test_months


#: Labels that results are compared by.
TRAINING, EXAM, PROJECTION = "entrenamiento", "examen", "proyeccion"
NEUTRAL, NEGATIVE, POSITIVE, MIXED = "neutro", "negativo", "positivo", "mixto"
PREDICTABLE, PAST_ONLY, FUTURE_ONLY = "predecible", "solo_historia", "solo_futuro"
UNKNOWN_DISCOUNT = "sin_dato"
NORMAL, TIME_SERIES = "normal", "serie_temporal"
