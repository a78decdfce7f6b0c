"""Event-grain features: trailing counts, gaps, and user features per event.

A single user may hold a large share of the log, so a window over "all events of
a user" is not something one task can be asked to sort. Windows run over *pieces*
of a user's history instead: calendar days, for a day that is crowded, each second of
it, and for a second that is crowded, ranges of items, which order the events of a
second. Days and seconds are what the clock says, so no stray timestamp changes how
the others are cut. What a piece needs from those before it - the last event and
how many there are, up to the longest frame - comes from one row per piece.
"""

from pyspark.sql import functions as F

from footfall.operators.user_features import daily_totals, user_features
from footfall.schema import EVENT_FEATURES, EVENT_ORDER, RAW_COLUMNS, TRAILING_EVENTS

# A user's day with more events than this is cut into seconds, a second with more into
# ranges of items.
CROWDED_DAY = 1_000_000

# The limit above grows with the log so that at most this many days, and as many
# seconds, can exceed it: each of them holds more than 1/MOST_CROWDED of all events.
MOST_CROWDED = 50_000

# Items of a crowded second are cut at some of the SLICES - 1 quantiles of this accuracy,
# found in blocks of BLOCK cuts. A second with more than SLICES times the limit, a fiftieth
# of the log, has SLICES ranges of more than the limit.
SLICES, BLOCK, CUT_ACCURACY = 1024, 32, 10_000

PIECE = ["user_id", "day", "second", "part"]


def crowded_days(events, crowded_day=CROWDED_DAY):
    """(user_id, day, limit) with more events than the limit; at most ``MOST_CROWDED``.

    The conditions on the other totals hold for every row. They keep all columns
    referenced, so this reads the shuffle that user features make of the totals.
    """
    daily = daily_totals(events).filter(
        "least(pv, cart, buy, fav) >= 0 AND first <= last AND coalesce(last_buy, last) <= last"
    )
    total = daily.agg(F.expr("sum(events) AS n")).scalar()
    return (
        daily.select("*", total.alias("total"))
        .selectExpr("*", f"greatest({crowded_day}, ceil(total / {MOST_CROWDED})) AS limit")
        .filter("events > limit")
        .select("user_id", "day", "limit")
    )


def _item_cuts(events):
    """Per (user_id, second) with more events than its limit: items at which to cut it.

    Of the cuts at all quantiles, as many stay as ranges of the limit's size need. A limit
    exceeds a ``MOST_CROWDED``-th of the log, so all cuts together are no more than
    twice ``MOST_CROWDED`` and may be broadcast. Without a crowded day nothing is read.
    """
    shares = ", ".join(f"{i / SLICES}D" for i in range(1, SLICES))
    return (
        events.groupBy("user_id", "second")
        .agg(
            F.expr(f"percentile_approx(item_id, array({shares}), {CUT_ACCURACY}) AS quantiles"),
            F.expr("count(*) AS n"),
            F.expr("max(limit) AS limit"),
        )
        .filter("n > limit")
        .selectExpr("*", f"int(greatest(1, floor(limit * {SLICES} / n))) AS step")
        .selectExpr(
            "user_id",
            "second",
            "array_distinct(filter(quantiles, (c, i) -> (i + 1) % step = 0)) AS cuts",
        )
        .selectExpr("*", f"filter(cuts, (c, i) -> (i + 1) % {BLOCK} = 0) AS starts")
    )


def in_pieces(events, crowded_day=CROWDED_DAY):
    """Events with the columns of ``PIECE``.

    ``second`` is 0 but on crowded days. ``part`` is the number of cuts below the item in
    crowded seconds, else 0.
    """
    crowded = F.broadcast(crowded_days(events, crowded_day))
    dated = events.selectExpr("*", "to_date(timestamp_seconds(timestamp)) AS day")
    cuts = _item_cuts(
        dated.join(crowded, ["user_id", "day"]).selectExpr(
            "user_id", "timestamp AS second", "item_id", "limit"
        )
    )
    below = "(a, c) -> a + if(c < item_id, 1, 0)"
    return (
        dated.join(crowded, ["user_id", "day"], "left")
        .selectExpr(*events.columns, "day", "if(limit IS NULL, 0L, timestamp) AS second")
        .join(F.broadcast(cuts), ["user_id", "second"], "left")
        .selectExpr(
            *events.columns, "day", "second", "cuts", f"aggregate(starts, 0, {below}) * {BLOCK} AS block"
        )
        .selectExpr(
            *events.columns,
            "day",
            "second",
            f"coalesce(block + aggregate(slice(cuts, block + 1, {BLOCK - 1}), 0, {below}), 0) AS part",
        )
    )


def _windowed(events, crowded_day):
    """Place in the piece and the neighbours there: one shuffle, one sort."""
    order = f"(PARTITION BY {', '.join(PIECE)} ORDER BY {', '.join(EVENT_ORDER)})"
    return in_pieces(events, crowded_day).selectExpr(
        "*",
        f"row_number() OVER {order} AS place",
        f"lag(timestamp) OVER {order} AS time_before",
        f"lag(behavior_type) OVER {order} AS behavior_before",
        f"lead(timestamp) OVER {order} AS time_after",
    )


def _carried(windowed, columns):
    """Per piece: the event before it and the events before it, as far as frames reach.

    Built from the last event of each piece, which the windows mark; ``columns``
    are all kept in it so that both uses of the windows share a shuffle. Every
    piece has an event, so as many pieces as the longest frame has rows suffice.
    One task orders the pieces of a user, never the events.
    """
    longest = max(TRAILING_EVENTS.values())
    last = windowed.filter("time_after IS NULL").selectExpr(
        *PIECE, "place", f"struct({', '.join(columns)}) AS last"
    )
    order = f"(PARTITION BY user_id ORDER BY {', '.join(PIECE[1:])}"
    return last.selectExpr(
        *PIECE,
        f"sum(place) OVER {order} ROWS BETWEEN {longest} PRECEDING AND 1 PRECEDING) AS before",
        f"lag(last) OVER {order}) AS previous",
    )


def _trailing(events, crowded_day, users=None):
    """``events`` with trailing counts, the gap to the last event and, if given, user columns.

    Cleaned events always have a behaviour, so counting the rows of a frame is
    the same as its position capped at the frame length, and a two-row frame is
    the current row plus the one before. User columns travel with the pieces, so
    events are shuffled once.
    """
    windowed = _windowed(events, crowded_day)
    carried = _carried(windowed, events.columns)
    own = []
    if users is not None:
        own = [c for c in users.columns if c != "user_id"]
        carried = carried.join(users, "user_id")
    joined = windowed.join(carried, PIECE).selectExpr(
        *events.columns,
        "place + coalesce(before, 0) AS position",
        "coalesce(time_before, previous.timestamp) AS earlier_time",
        "coalesce(behavior_before, previous.behavior_type) AS earlier_behavior",
        *own,
    )
    return joined.selectExpr(
        *events.columns,
        *[
            f"bigint(least(position, {length})) AS {name}"
            for name, length in TRAILING_EVENTS.items()
        ],
        *[
            f"bigint(if(behavior_type = '{name}', 1, 0) + if(earlier_behavior = '{name}', 1, 0))"
            f" AS item_{name}_count_1d"
            for name in ("pv", "cart", "buy")
        ],
        "timestamp - earlier_time AS time_since_last_behavior",
        *own,
    )


def trailing_features(events, crowded_day=CROWDED_DAY):
    """Cleaned events with their trailing counts and gap."""
    return _trailing(events, crowded_day)


def event_features(events, as_of=None, crowded_day=CROWDED_DAY):
    """Cleaned events with all features, user features repeated on each event.

    The log is scanned three times: for the daily totals, for the items of users,
    and for the windows.
    """
    return (
        _trailing(events, crowded_day, user_features(events, as_of))
        .selectExpr(
            "*",
            "timestamp_seconds(timestamp) AS timestamp_ts",
            "hour(timestamp_seconds(timestamp)) AS hour",
            "dayofweek(timestamp_seconds(timestamp)) AS day_of_week",
            "time_since_last_behavior AS behavior_interval",
        )
        .select(*RAW_COLUMNS, "datetime", *EVENT_FEATURES)
    )
