"""Cleaning and validation of a raw log."""

from pyspark.sql import functions as F

from footfall.schema import BEHAVIORS, EVENT_KEY, RAW_COLUMNS


def valid_lines(raw):
    """Complete lines with a known behaviour, copies still present."""
    known = ", ".join(f"'{name}'" for name in BEHAVIORS)
    complete = [f"{column} IS NOT NULL" for column in RAW_COLUMNS]
    return raw.filter(" AND ".join([*complete, f"behavior_type IN ({known})"]))


def clean_events(raw):
    """One row per event, with its local time as text.

    Lines are filtered before copies are merged, so a copy that lost its
    category never hides a complete one. The merge is an aggregate: copies
    collapse on the map side, and however many copies an event has, at most one
    row per input partition is shuffled for it.

    The last filter holds for every row. It keeps ``category_id`` referenced in
    every branch of a larger plan, so branches that need different columns
    still share one shuffle of the log.
    """
    return (
        valid_lines(raw)
        .groupBy(*EVENT_KEY)
        .agg(F.expr("min(category_id) AS category_id"))
        .filter("category_id IS NOT NULL")
        .selectExpr(*RAW_COLUMNS, "from_unixtime(timestamp) AS datetime")
    )


def validation_counts(cleaned):
    """Events, users, items and categories.

    Each column's distinct values are counted on their own: several distinct counts in
    one aggregate would copy every event for each of them.
    """

    def distinct(column):
        values = cleaned.select(column).distinct()
        return values.selectExpr(f"count({column}) AS n").scalar()

    return cleaned.selectExpr("count(*) AS total_records").select(
        "total_records",
        distinct("user_id").alias("user_count"),
        distinct("item_id").alias("item_count"),
        distinct("category_id").alias("category_count"),
    )


def behavior_counts(cleaned):
    return cleaned.groupBy("behavior_type").agg(F.expr("count(*) AS count"))
