"""Literal tables with known results: customers of a phone company, and whether they left."""

COLUMNS = ["LEFT", "MONTHS", "PLAN", "OVERDUE", "CONTRACT"]
SCHEMA = "LEFT double, MONTHS double, PLAN string, OVERDUE double, CONTRACT string"

# One null each in a number and two strings; months 3.0 are a tie between a customer who left and one who stayed.
TRAIN = [
    (0.0, 24.5, "basic", 12.0, "yearly"),
    (1.0, 3.0, "basic", 40.25, "monthly"),
    (0.0, 17.75, "family", 0.0, "monthly"),
    (0.0, 3.0, "basic", 8.5, "monthly"),
    (1.0, 30.25, "student", 22.0, "monthly"),
    (0.0, 41.0, "family", 5.75, "yearly"),
    (0.0, None, "basic", 12.0, "yearly"),
    (1.0, 28.0, "basic", 63.5, None),
    (0.0, 9.5, "family", 3.25, "monthly"),
    (0.0, 52.0, "basic", 0.0, "monthly"),
    (1.0, 23.25, None, 40.25, "monthly"),
    (0.0, 36.5, "student", 7.0, "yearly"),
    (0.0, 12.0, "basic", 1.5, "monthly"),
    (1.0, 44.75, "family", 22.0, "monthly"),
    (0.0, 19.0, "basic", 9.0, "monthly"),
    (0.0, 15.5, "family", 4.0, "yearly"),
]

# Later figures of the same customers: months of all known, and a plan that training has not seen.
HOLDOUT = [
    (0.0, 25.5, "basic", 10.0, "yearly"),
    (1.0, 4.0, "basic", 44.75, "monthly"),
    (0.0, 18.75, "family", 0.0, "monthly"),
    (0.0, 4.0, "basic", 6.25, "monthly"),
    (1.0, 31.25, "student", 25.0, "monthly"),
    (0.0, 42.0, "family", 5.75, "yearly"),
    (0.0, 21.25, "basic", 14.0, "yearly"),
    (1.0, 29.0, "basic", 70.0, None),
    (0.0, 10.5, "family", 2.0, "monthly"),
    (0.0, 53.0, "basic", 0.0, "monthly"),
    (1.0, 24.25, "student", 38.0, "monthly"),
    (0.0, 37.5, "student", 9.5, "yearly"),
    (0.0, 13.0, "basic", 1.5, "monthly"),
    (1.0, 45.75, "family", 31.5, "monthly"),
    (0.0, 20.0, "senior", 9.0, "monthly"),
    (0.0, 16.5, "family", 3.0, "yearly"),
]

SUM_COLUMNS = ["SHOP", "mon", "tue", "wed"]
SUM_ROWS = [("north", 31, 0, 14), ("south", -8, 22, 3), ("harbour", 120, 95, 101)]
SUMS = {"north": 45, "south": 17, "harbour": 316}


def frame(spark, rows):
    """The rows with a 0-based row number as ``id``."""
    return spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], f"id bigint, {SCHEMA}").coalesce(1)
