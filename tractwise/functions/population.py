"""The prime-age measure."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from tractwise.columns import MINORS, SENIORS


def prime_age_raw() -> Column:
    """People out of work or out of the labour force who are neither in group
    quarters, nor adult students, nor of retirement age. May be negative."""
    adult_students = " - ".join(["in_school", *MINORS])
    retired = " + ".join(SENIORS)
    return F.expr(
        "unemployed_pop + not_in_labor_force - group_quarters"
        f" - ({adult_students}) - ({retired})"
    )
