"""User-grain features."""

from pyspark.sql import functions as F

from footfall.functions.expressions import day_literal
from footfall.schema import STORED_FEATURES


def daily_totals(events):
    """Counts and extremes per user and calendar day.

    The filter holds for every cleaned event. Joins on the keys would add it in
    some uses only, which then could not share a shuffle.
    """
    return (
        events.selectExpr(
            "user_id", "to_date(timestamp_seconds(timestamp)) AS day", "behavior_type", "timestamp"
        )
        .filter("user_id IS NOT NULL AND day IS NOT NULL")
        .groupBy("user_id", "day")
        .agg(
            F.expr("count(behavior_type) AS events"),
            F.expr("count_if(behavior_type = 'pv') AS pv"),
            F.expr("count_if(behavior_type = 'cart') AS cart"),
            F.expr("count_if(behavior_type = 'buy') AS buy"),
            F.expr("count_if(behavior_type = 'fav') AS fav"),
            F.expr("min(timestamp) AS first"),
            F.expr("max(timestamp) AS last"),
            F.expr("max(CASE WHEN behavior_type = 'buy' THEN timestamp END) AS last_buy"),
        )
    )


def user_features(events, as_of=None, with_events=False):
    """One row per user, from aggregates only.

    Two distinct counts in one Spark aggregate would copy every event three
    times. Days are counted from daily totals instead, which the other measures
    are summed from, and items in an aggregate of their own. Both are grouped by
    (user, value) before they are grouped by user, so the events of a very
    active user are combined in many tasks; both end up partitioned by user, so
    the join adds no shuffle. It is a left join on a unique key: Spark drops it
    from queries that do not ask for the item count.

    The mean gap between events is (last - first) / (events - 1): the gaps of
    consecutive events add up to that span. A user bought recently if the last
    purchase is recent, dates after ``as_of`` included. ``with_events`` adds the
    number of events.
    """
    today = day_literal(as_of)
    items = events.groupBy("user_id").agg(
        F.expr("count(DISTINCT item_id) AS item_category_count")
    )
    sums = [F.expr(f"sum({c}) AS {c}") for c in ("events", "pv", "cart", "buy", "fav")]
    totals = (
        daily_totals(events)
        .groupBy("user_id")
        .agg(
            F.expr("count(day) AS active_days"),
            *sums,
            F.expr("min(first) AS first"),
            F.expr("max(last) AS last"),
            F.expr("max(last_buy) AS last_buy"),
        )
        .join(items, "user_id", "left")
    )
    return totals.selectExpr(
        "user_id",
        "item_category_count",
        "active_days",
        "timestamp_seconds(last) AS last_behavior_time",
        f"datediff({today}, to_date(timestamp_seconds(last))) AS days_since_last_behavior",
        "try_divide(pv, events) AS pv_ratio",
        "try_divide(cart, events) AS cart_ratio",
        "try_divide(buy, events) AS buy_ratio",
        "try_divide(fav, events) AS fav_ratio",
        "coalesce(try_divide(buy, cart), 0D) AS cart2buy_rate",
        "try_divide(last - first, events - 1) AS avg_behavior_interval",
        f"if(datediff({today}, to_date(timestamp_seconds(last_buy))) <= 7, 1, 0) AS recent_7d_buy",
        *(["events"] if with_events else []),
    )


def users_of_event_features(features):
    """One row per user out of event-grain features.

    Every stored feature is constant within its user, so any aggregate that
    skips nulls returns it; ``max`` combines on the map side.
    """
    return features.groupBy("user_id").agg({c: "max" for c in STORED_FEATURES}).selectExpr(
        "user_id", *[f"`max({c})` AS {c}" for c in STORED_FEATURES]
    )


def stored_rows(users):
    """The columns and types of the user table, nulls stored as 0."""
    return users.selectExpr(
        "user_id", *[f"cast(coalesce({c}, 0) AS {t}) AS {c}" for c, t in STORED_FEATURES.items()]
    )
