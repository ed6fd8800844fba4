"""Years, intervals and ISO timestamps."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def years_compatible(birth_a: Column, death_a: Column, birth_b: Column, death_b: Column, tolerance: int = 2) -> Column:
    """Known years may differ by the tolerance; unknown ones never disagree."""
    apart = lambda x, y: F.coalesce(F.abs(x - y) > tolerance, F.lit(False))
    return ~(apart(birth_a, birth_b) | apart(death_a, death_b))


def as_of(start: Column, end: Column, at: Column) -> Column:
    """Whether a validity interval, open where null, holds at a time; its end is exclusive."""
    return (start.isNull() | (start <= at)) & (end.isNull() | (end > at))


def life_span(birth: Column, death: Column) -> Column:
    """`1632-1704`, `428 BCE-?`, null if both are unknown."""
    of = lambda y: F.when(y.isNull(), F.lit("?")).when(y < 0, F.concat(F.abs(y).cast("string"), F.lit(" BCE"))).otherwise(y.cast("string"))
    return F.when(birth.isNull() & death.isNull(), F.lit(None)).otherwise(F.concat(of(birth), F.lit("-"), of(death)))


def assumed_death(birth: Column, death: Column, lifespan: int = 80) -> Column:
    return F.coalesce(death, birth + lifespan)


def full_time(value: Column, fallback: str = "1970-01-01T00:00:00Z") -> Column:
    """A date becomes its midnight in UTC, a missing value the fallback."""
    text = F.trim(value)
    return F.when(value.isNull() | (text == ""), F.lit(fallback)).when(F.length(text) == 10, F.concat(text, F.lit("T00:00:00Z"))).otherwise(text)


def iso_problem(value: Column) -> Column:
    """Null, `format.iso8601` or `format.timezone`."""
    parsed = F.try_to_timestamp(F.replace(value, F.lit("Z"), F.lit("+00:00")))
    return F.when(value.isNull(), F.lit(None)).when(parsed.isNull(), F.lit("format.iso8601")).when(~value.rlike(r"(?:Z|[+-]\d{2}:?\d{2})$"), F.lit("format.timezone"))
