"""Forecast horizons."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, timedelta

# Last training day, first forecast date and length of the two horizons.
STEPS = 28
TRAIN_LAST = {"validation": 1913, "evaluation": 1941}
FIRST_DAY = {"validation": date(2016, 4, 25), "evaluation": date(2016, 5, 23)}


@dataclass(frozen=True)
class Horizon:
    """Days up to ``train_last`` are history; the ``steps`` days after it are forecast."""

    label: str
    train_last: int
    first_day: date
    steps: int = STEPS

    @classmethod
    def named(cls, label: str) -> "Horizon":
        if label not in TRAIN_LAST:
            raise ValueError(f"unknown horizon {label!r}")
        return cls(label, TRAIN_LAST[label], FIRST_DAY[label])

    @property
    def last(self) -> int:
        return self.train_last + self.steps

    def date_of(self, day: int) -> date:
        return self.first_day + timedelta(days=day - self.train_last - 1)

    @property
    def step_names(self) -> list[str]:
        return [f"F{i}" for i in range(1, self.steps + 1)]
