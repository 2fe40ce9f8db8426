"""Labels and calendar fields as plain column expressions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, functions as F

# Calendar months of each season; the remaining months are autumn.
SEASONS = {"winter": (12, 1, 2), "spring": (3, 4, 5), "summer": (6, 7, 8)}
LAST_SEASON = "autumn"

# day_of_week 1 is Sunday and 7 is Saturday.
WEEKEND_DAYS = (1, 7)


def _first_match(cases: Sequence[tuple[Column, str]], default: str) -> Column:
    expression = F
    for condition, label in cases:
        expression = expression.when(condition, F.lit(label))
    return expression.otherwise(F.lit(default))


def map_codes(
    code: Column,
    groups: Mapping[str, Sequence[int]],
    default: str,
    above: tuple[int, str] | None = None,
) -> Column:
    """Category of an integer code; ``above`` names unlisted codes past a bound, NULL gets ``default``."""
    cases = [(code.isin(*codes), label) for label, codes in groups.items()]
    if above is not None:
        cases.append((code > above[0], above[1]))
    return _first_match(cases, default)


def priority_label(flag_labels: Mapping[str, str], default: str) -> Column:
    """Label of the first 0/1 flag column that is 1, in the order given."""
    return _first_match([(F.col(flag) == 1, label) for flag, label in flag_labels.items()], default)


def season(day: Column) -> Column:
    """Meteorological season of a date."""
    month = F.month(day)
    return _first_match([(month.isin(*months), name) for name, months in SEASONS.items()], LAST_SEASON)


def day_type(day_of_week: Column) -> Column:
    """``weekend`` for Saturday and Sunday, else ``weekday``."""
    return _first_match([(day_of_week.isin(*WEEKEND_DAYS), "weekend")], "weekday")


def rejection_reason(reasons: Mapping[str, str]) -> Column:
    """Comma-joined reasons of the false flags, from ``{reason: flag column}``; empty when none failed."""
    return F.concat_ws(",", *[F.when(~F.col(flag), F.lit(reason)) for reason, flag in reasons.items()])


def to_label(col: Column) -> Column:
    """Boolean target as 0.0 or 1.0."""
    return col.cast("double")


def positive_score(vector: Column) -> Column:
    """Probability of the positive class from a two-class probability vector."""
    return vector_to_array(vector)[1]
