"""Grades of a measured value and their order."""

from pyspark.sql import Column, functions as F

from sensorloom.functions.columns import column
from sensorloom.schemas import GRADES, THRESHOLDS


def grade(value: Column, unknown: str | None = None) -> Column:
    """First grade whose upper bound the value does not exceed, else the worst grade.

    A NULL value or bound compares as unknown and so ends at the worst grade, unless
    ``unknown`` names a label for such rows.
    """
    bounds = [column(name) for name in THRESHOLDS[:3]]
    graded = F.when(value <= bounds[0], F.lit(GRADES[0]))
    for bound, label in zip(bounds[1:], GRADES[1:3]):
        graded = graded.when(value <= bound, F.lit(label))
    graded = graded.otherwise(F.lit(GRADES[3]))
    if unknown is None:
        return graded
    missing = value.isNull()
    for bound in bounds:
        missing = missing | bound.isNull()
    return F.when(missing, F.lit(unknown)).otherwise(graded)


def grade_rank(status: Column) -> Column:
    """1 for the best grade to 4 for the worst; 99 for anything else."""
    ranked = F.when(status == GRADES[0], 1)
    for rank, label in enumerate(GRADES[1:], start=2):
        ranked = ranked.when(status == label, rank)
    return ranked.otherwise(99)
