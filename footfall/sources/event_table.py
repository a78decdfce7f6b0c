"""Mapping of the driver's ``events`` table onto the raw behaviour log.

Every event is used. One pass over the file, no shuffle: copies are made with
``explode`` and the number of active days is varied by folding each user's
calendar, so users cover the whole range from one day to thirty.
"""

# Event types of the table and the behaviours they stand for.
# A type that is not listed keeps its name, so cleaning has rows to reject.
BEHAVIOR_OF = {"view": "pv", "click": "cart", "signup": "fav", "purchase": "buy"}

FIRST_DAY = 19723  # 2024-01-01 in days since the epoch


def raw_log_from_events(events):
    """``events`` as raw log rows.

    * item: the number ``k`` inside ``props``; category: ``k`` in tens
    * one user in ten never buys and one in ten never uses the cart: they view
    * a line with a value below 0.5 has no category
    * lines of items 0..4 arrive twice, and the second line of item 0 has lost
      its category
    * user ``u`` is active on ``1 + 7u mod 30`` calendar days: later days are
      folded back onto the first ones
    """
    behavior = " ".join(
        f"WHEN event_type = '{kind}' THEN '{name}'" for kind, name in BEHAVIOR_OF.items()
    )
    return (
        events.selectExpr(
            "user_id",
            "value",
            "cast(get_json_object(props, '$.k') AS bigint) AS item_id",
            "CASE WHEN event_type = 'purchase' AND pmod(user_id, 10) = 0 THEN 'pv'"
            " WHEN event_type = 'click' AND pmod(user_id, 10) = 5 THEN 'pv'"
            f" {behavior} ELSE event_type END AS behavior_type",
            "unix_timestamp(ts) AS seconds",
        )
        .selectExpr(
            "*",
            "seconds div 86400 AS day",
            "explode(CASE WHEN item_id < 5 THEN array(1, 2) ELSE array(1) END) AS copy",
        )
        .selectExpr(
            "user_id",
            "item_id",
            "CASE WHEN value >= 0.5 AND (item_id <> 0 OR copy = 1) THEN item_id div 10 END"
            " AS category_id",
            "behavior_type",
            f"seconds - 86400 * (day - {FIRST_DAY}"
            f" - pmod(day - {FIRST_DAY}, 1 + pmod(user_id * 7, 30))) AS timestamp",
        )
    )


def read_events(spark, folder):
    """The raw log behind a folder of driver tables, in UTC."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return raw_log_from_events(spark.read.parquet(f"{folder}/events.parquet"))
