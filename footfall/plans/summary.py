"""Overview figures and segments of the user table."""

from pyspark.sql import functions as F

from footfall.functions.expressions import USER_SEGMENT


def activity_summary(users):
    return users.selectExpr(
        "count(*) AS total_users",
        "min(active_days) AS min_active_days",
        "max(active_days) AS max_active_days",
        "avg(active_days) AS avg_active_days",
        "count_if(active_days = 1) AS single_day_users",
        "count_if(active_days >= 5) AS high_active_users",
    )


def purchase_summary(users):
    return users.selectExpr(
        "count_if(buy_ratio > 0) AS buyers",
        "count_if(buy_ratio = 0) AS non_buyers",
        "avg(buy_ratio) AS avg_buy_ratio",
        "max(buy_ratio) AS max_buy_ratio",
    )


def user_segments(users):
    """Users per segment with their share in percent, largest segment first.

    The total is a window over the grouped rows, of which there are at most
    four, so users are read once.
    """
    return (
        users.selectExpr(f"{USER_SEGMENT} AS user_segment")
        .groupBy("user_segment")
        .agg(F.expr("count(*) AS user_count"))
        .selectExpr("*", "round(user_count * 100D / sum(user_count) OVER (), 2) AS percentage")
        .orderBy(F.desc("user_count"), "user_segment")
    )
