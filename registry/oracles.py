"""The registered queries as SQL for DuckDB, over the same tables.

Written from the definitions rather than from the Spark code: real row frames,
a real average of gaps, bins found by comparing with their edges.
"""

LOG = """
WITH lines AS (
  SELECT user_id, value,
         CAST(regexp_extract(props, '"k": *([0-9]+)', 1) AS BIGINT) AS item_id,
         CASE WHEN event_type = 'view' THEN 'pv'
              WHEN event_type = 'click' THEN CASE user_id % 10 WHEN 5 THEN 'pv' ELSE 'cart' END
              WHEN event_type = 'signup' THEN 'fav'
              WHEN event_type = 'purchase' THEN CASE user_id % 10 WHEN 0 THEN 'pv' ELSE 'buy' END
              ELSE event_type END AS behavior_type,
         CAST(floor(epoch(ts)) AS BIGINT) AS seconds
  FROM events
), folded AS (
  SELECT user_id, item_id, value, behavior_type,
         seconds - (seconds // 86400
           - (19723 + (seconds // 86400 - 19723) % (1 + (user_id * 7) % 30))) * 86400
           AS "timestamp"
  FROM lines
), raw AS (
  SELECT user_id, item_id, CASE WHEN value >= 0.5 THEN item_id // 10 END AS category_id,
         behavior_type, "timestamp"
  FROM folded
  UNION ALL
  SELECT user_id, item_id,
         CASE WHEN value >= 0.5 AND item_id <> 0 THEN item_id // 10 END,
         behavior_type, "timestamp"
  FROM folded WHERE item_id < 5
), cleaned AS (
  SELECT user_id, item_id, min(category_id) AS category_id, behavior_type, "timestamp",
         strftime(make_timestamp("timestamp" * 1000000), '%Y-%m-%d %H:%M:%S') AS datetime
  FROM raw
  WHERE user_id IS NOT NULL AND item_id IS NOT NULL AND category_id IS NOT NULL
    AND behavior_type IN ('pv', 'buy', 'cart', 'fav') AND "timestamp" IS NOT NULL
  GROUP BY user_id, item_id, behavior_type, "timestamp"
)"""

SEQUENCED = """
, sequenced AS (
  SELECT *,
    count(behavior_type) OVER (o ROWS 1 PRECEDING) AS pv_count_1d,
    count(behavior_type) OVER (o ROWS 7 PRECEDING) AS pv_count_7d,
    count(behavior_type) OVER (o ROWS 30 PRECEDING) AS pv_count_30d,
    count(CASE WHEN behavior_type = 'pv' THEN 1 END) OVER (o ROWS 1 PRECEDING)
      AS item_pv_count_1d,
    count(CASE WHEN behavior_type = 'cart' THEN 1 END) OVER (o ROWS 1 PRECEDING)
      AS item_cart_count_1d,
    count(CASE WHEN behavior_type = 'buy' THEN 1 END) OVER (o ROWS 1 PRECEDING)
      AS item_buy_count_1d,
    "timestamp" - lag("timestamp") OVER o AS time_since_last_behavior
  FROM cleaned
  WINDOW o AS (PARTITION BY user_id ORDER BY "timestamp", item_id, behavior_type)
)"""


def features_of(name, events, as_of):
    """User features of an event relation, as two more CTEs ending in ``name``."""
    day = "CAST(make_timestamp(\"timestamp\" * 1000000) AS DATE)"
    return f"""
, {name}_gaps AS (
  SELECT *, {day} AS d,
    "timestamp" - lag("timestamp") OVER (PARTITION BY user_id
      ORDER BY "timestamp", item_id, behavior_type) AS gap
  FROM {events}
), {name} AS (
  SELECT user_id,
    count(DISTINCT item_id) AS item_category_count,
    count(DISTINCT d) AS active_days,
    strftime(make_timestamp(max("timestamp") * 1000000), '%Y-%m-%d %H:%M:%S')
      AS last_behavior_time,
    CAST(date_diff('day', max(d), DATE '{as_of}') AS INTEGER) AS days_since_last_behavior,
    count(CASE WHEN behavior_type = 'pv' THEN 1 END) / count(*) AS pv_ratio,
    count(CASE WHEN behavior_type = 'cart' THEN 1 END) / count(*) AS cart_ratio,
    count(CASE WHEN behavior_type = 'buy' THEN 1 END) / count(*) AS buy_ratio,
    count(CASE WHEN behavior_type = 'fav' THEN 1 END) / count(*) AS fav_ratio,
    CASE WHEN count(CASE WHEN behavior_type = 'cart' THEN 1 END) > 0
      THEN count(CASE WHEN behavior_type = 'buy' THEN 1 END)
           / count(CASE WHEN behavior_type = 'cart' THEN 1 END)
      ELSE 0.0::DOUBLE END AS cart2buy_rate,
    avg(gap) AS avg_behavior_interval,
    CAST(max(CASE WHEN behavior_type = 'buy'
      AND date_diff('day', d, DATE '{as_of}') <= 7 THEN 1 ELSE 0 END) AS INTEGER)
      AS recent_7d_buy
  FROM {name}_gaps GROUP BY user_id
)"""


def stored_of(name, users):
    return f"""
, {name} AS (
  SELECT user_id, CAST(active_days AS INTEGER) AS active_days, days_since_last_behavior,
    pv_ratio, cart_ratio, buy_ratio, fav_ratio, cart2buy_rate,
    coalesce(avg_behavior_interval, 0) AS avg_behavior_interval, recent_7d_buy,
    CAST(item_category_count AS INTEGER) AS item_category_count
  FROM {users}
)"""


AS_OF = "2024-01-31"
USERS = LOG + features_of("users", "cleaned", AS_OF)
STORED = USERS + stored_of("stored", "users")

RATIOS = ["pv_ratio", "cart_ratio", "buy_ratio", "fav_ratio", "cart2buy_rate"]
DOUBLES = [*RATIOS, "avg_behavior_interval"]
STORED_COLUMNS = [
    "active_days", "days_since_last_behavior", *DOUBLES, "recent_7d_buy", "item_category_count",
]


def shown(columns, digits=6):
    return ", ".join(f"round({c}, {digits}) AS {c}" if c in DOUBLES else c for c in columns)


ROW = "user_id, " + shown(STORED_COLUMNS)
KEY = 'user_id, item_id, behavior_type, "timestamp"'
PV_COUNTS = "pv_count_1d, pv_count_7d, pv_count_30d"
BEHAVIOR_COUNTS = "item_pv_count_1d, item_cart_count_1d, item_buy_count_1d"

EVENT_FEATURES = USERS + SEQUENCED + """
, featured AS (
  SELECT e.user_id, e.item_id, e.category_id, e.behavior_type, e."timestamp", e.datetime,
    e.datetime AS timestamp_ts,
    CAST(hour(make_timestamp(e."timestamp" * 1000000)) AS INTEGER) AS hour,
    CAST(dayofweek(make_timestamp(e."timestamp" * 1000000)) + 1 AS INTEGER) AS day_of_week,
    pv_count_1d, pv_count_7d, pv_count_30d,
    item_pv_count_1d, item_cart_count_1d, item_buy_count_1d, time_since_last_behavior,
    u.item_category_count, u.active_days, u.last_behavior_time, u.days_since_last_behavior,
    u.pv_ratio, u.cart_ratio, u.buy_ratio, u.fav_ratio, u.cart2buy_rate,
    time_since_last_behavior AS behavior_interval, u.avg_behavior_interval, u.recent_7d_buy
  FROM sequenced e JOIN users u ON e.user_id = u.user_id
)"""
# Column name and Spark type, in output order.
FEATURED = {
    "user_id": "bigint", "item_id": "bigint", "category_id": "bigint",
    "behavior_type": "string", "timestamp": "bigint", "datetime": "string",
    "timestamp_ts": "timestamp", "hour": "int", "day_of_week": "int",
    "pv_count_1d": "bigint", "pv_count_7d": "bigint", "pv_count_30d": "bigint",
    "item_pv_count_1d": "bigint", "item_cart_count_1d": "bigint", "item_buy_count_1d": "bigint",
    "time_since_last_behavior": "bigint", "item_category_count": "bigint",
    "active_days": "bigint", "last_behavior_time": "timestamp",
    "days_since_last_behavior": "int", "pv_ratio": "double", "cart_ratio": "double",
    "buy_ratio": "double", "fav_ratio": "double", "cart2buy_rate": "double",
    "behavior_interval": "bigint", "avg_behavior_interval": "double", "recent_7d_buy": "int",
}
NUMERIC = [c for c, t in FEATURED.items() if t not in ("string", "timestamp")]
SAMPLED = EVENT_FEATURES + """
, sampled AS (
  SELECT * FROM featured ORDER BY user_id, "timestamp", item_id, behavior_type LIMIT 1000
)"""


def quoted(name):
    return f'"{name}"'


def describe():
    parts = []
    for column, kind in FEATURED.items():
        c = quoted(column)
        if column in NUMERIC:
            parts.append(
                f"SELECT '{column}' AS column_name, count({c}) AS count, round(avg({c}), 3) AS mean,"
                f" round(stddev_samp({c}), 3) AS stddev, round(CAST(min({c}) AS DOUBLE), 3) AS min,"
                f" round(CAST(max({c}) AS DOUBLE), 3) AS max, NULL::VARCHAR AS min_text,"
                f" NULL::VARCHAR AS max_text FROM featured"
            )
        elif kind == "string":
            parts.append(
                f"SELECT '{column}', count({c}), NULL, NULL, NULL, NULL, min({c}), max({c})"
                " FROM featured"
            )
    return EVENT_FEATURES + " UNION ALL ".join(parts)


def quartiles():
    parts = []
    for column in NUMERIC:
        c = f"CAST({quoted(column)} AS DOUBLE)"
        parts.append(
            f"SELECT '{column}' AS column_name, count({c}) AS count, round(avg({c}), 3) AS mean,"
            f" round(stddev_samp({c}), 3) AS std, round(min({c}), 3) AS min,"
            f" round(quantile_cont({c}, 0.25), 3) AS p25, round(quantile_cont({c}, 0.5), 3) AS p50,"
            f" round(quantile_cont({c}, 0.75), 3) AS p75, round(max({c}), 3) AS max FROM featured"
        )
    return EVENT_FEATURES + " UNION ALL ".join(parts)


def schema_rows():
    parts = [
        f"SELECT CAST({i} AS INTEGER) AS position, '{c}' AS column_name, '{t}' AS data_type,"
        f" count({quoted(c)}) AS \"values\" FROM featured"
        for i, (c, t) in enumerate(FEATURED.items(), 1)
    ]
    return EVENT_FEATURES + " UNION ALL ".join(parts)


LEVELS = """
, levels AS (
  SELECT * FROM (VALUES (0, '0d', 0, -1), (1, '1-7d', 1, 1), (2, '8-30d', 7, 7),
    (3, '31-90d', 30, 30), (4, '91-365d', 90, 90), (5, '>365d', 365, 365))
    t(position, level, low, above)
  WHERE above < (SELECT max(active_days) FROM stored)
), leveled AS (
  SELECT s.*, (SELECT arg_max(level, low) FROM levels WHERE low <= s.active_days) AS level
  FROM stored s
)"""



def boxes(value):
    return LEVELS + f"""
, quarters AS (
  SELECT level, count(*) AS count, quantile_cont({value}, 0.25) AS q1,
    quantile_cont({value}, 0.5) AS median, quantile_cont({value}, 0.75) AS q3
  FROM leveled GROUP BY level
), fenced AS (
  SELECT l.user_id, l.level, l.{value} AS value, q1, q3,
    l.{value} BETWEEN q1 - (q3 - q1) * 1.5 AND q3 + (q3 - q1) * 1.5 AS inside
  FROM leveled l JOIN quarters q ON l.level = q.level
)"""


def box_stats(value):
    return STORED + boxes(value) + """
        SELECT l.position, l.level, coalesce(q.count, 0) AS count, round(q.q1, 6) AS q1,
          round(q.median, 6) AS median, round(q.q3, 6) AS q3,
          round(least(w.low, q.q1), 6) AS whisker_low,
          round(greatest(w.high, q.q3), 6) AS whisker_high,
          coalesce(w.outliers, 0) AS outliers
        FROM levels l LEFT JOIN quarters q ON l.level = q.level
        LEFT JOIN (SELECT level, min(value) FILTER (inside) AS low,
                     max(value) FILTER (inside) AS high,
                     count(*) FILTER (NOT inside) AS outliers
                   FROM fenced GROUP BY level) w ON l.level = w.level"""


def cumulative(value):
    return STORED + f"""
        SELECT round({value}, 6) AS value, n, round(share, 6) AS share FROM (
          SELECT {value}, count(*) AS n, max(c) AS share
          FROM (SELECT {value}, cume_dist() OVER (ORDER BY {value}) AS c FROM stored)
          GROUP BY {value})"""


def histogram(source, column, bins):
    """Counts between the edges low + i * width, the last bin closed."""
    return f"""
, extent AS (
  SELECT CASE WHEN min({column}) = max({column}) THEN min({column}) - 0.5 ELSE min({column}) END
           AS low,
         CASE WHEN min({column}) = max({column}) THEN max({column}) + 0.5 ELSE max({column}) END
           AS high
  FROM {source}
), edges AS (
  SELECT i AS bin, low + i * ((high - low) / {bins}) AS bin_low,
    CASE WHEN i = {bins} - 1 THEN high ELSE low + (i + 1) * ((high - low) / {bins}) END AS bin_high
  FROM extent, range({bins}) r(i)
)
SELECT e.bin, round(bin_low, 6) AS bin_low, round(bin_high, 6) AS bin_high,
  count(s.{column}) AS count
FROM edges e LEFT JOIN {source} s
  ON s.{column} >= e.bin_low
 AND (s.{column} < e.bin_high OR (e.bin = {bins} - 1 AND s.{column} <= e.bin_high))
GROUP BY e.bin, bin_low, bin_high"""


def density(series_rows, points=200, cut=0):
    """Kernel density of (series, value) rows, from the definition."""
    return f"""
, rows_in AS ({series_rows}), fits AS (
  SELECT series, count(*) AS n, stddev_samp(value) * pow(count(*), -0.2) AS h,
    min(value) AS low, max(value) AS high
  FROM rows_in GROUP BY series HAVING stddev_samp(value) > 0
), grid AS (
  SELECT series, n, h, CAST(i AS INTEGER) AS point,
    low - {cut} * h + i * (((high + {cut} * h) - (low - {cut} * h)) / {points - 1}) AS x
  FROM fits, range({points}) r(i)
), weights AS (
  SELECT series, value, count(*) AS w FROM rows_in GROUP BY series, value
)
SELECT g.series, g.point, round(g.x, 6) AS x,
  round(sum(w.w * exp(-0.5 * pow((g.x - w.value) / g.h, 2))) / (g.n * g.h * sqrt(2 * pi())), 6)
    AS density
FROM grid g JOIN weights w ON g.series = w.series
GROUP BY g.series, g.point, g.x, g.n, g.h"""


def series(*columns):
    return " UNION ALL ".join(
        f"SELECT '{c}' AS series, CAST({c} AS DOUBLE) AS value FROM stored" for c in columns
    )


CELLS = STORED + ", cells AS (" + " UNION ALL ".join(
    f"SELECT CAST(user_id AS VARCHAR) AS row_key, 'f:{c}' AS \"column\","
    f" CAST({c} AS DOUBLE) AS value FROM stored"
    for c in STORED_COLUMNS
) + ")"

EARLY = 'SELECT * FROM cleaned WHERE "timestamp" < 1704153600'
LATE = 'SELECT * FROM cleaned WHERE "timestamp" >= 1704153600'
TWO_LOADS = (
    LOG
    + f", early AS ({EARLY}), late AS ({LATE})"
    + features_of("users1", "early", "2024-01-30")
    + features_of("users2", "late", AS_OF)
    + stored_of("load1", "users1")
    + stored_of("load2", "users2")
    + """
, merged AS (
  SELECT * FROM load2
  UNION ALL
  SELECT * FROM load1 WHERE user_id NOT IN (SELECT user_id FROM load2)
)"""
)

UPSERTED = TWO_LOADS + f"""
  SELECT {ROW}, CASE WHEN user_id IN (SELECT user_id FROM load1)
    THEN '2024-01-30 00:00:00' ELSE '2024-01-31 00:00:00' END AS created_at
  FROM merged"""

MERGED_CELLS = " UNION ALL ".join(
    f"SELECT CAST(user_id AS VARCHAR) AS row_key, 'f:{c}' AS \"column\","
    f" round(CAST({c} AS DOUBLE), 6) AS value FROM merged"
    for c in STORED_COLUMNS
)

SEGMENT = """CASE WHEN active_days = 1 THEN '单日用户'
  WHEN active_days BETWEEN 2 AND 4 THEN '低频用户'
  WHEN active_days BETWEEN 5 AND 9 THEN '中频用户' ELSE '高频用户' END"""

ORACLES = {
    "clean_events": LOG + "SELECT * FROM cleaned",
    "validate_counts": LOG + """
        SELECT count(*) AS total_records, count(DISTINCT user_id) AS user_count,
          count(DISTINCT item_id) AS item_count, count(DISTINCT category_id) AS category_count
        FROM cleaned""",
    "behavior_counts": LOG + "SELECT behavior_type, count(*) AS count FROM cleaned GROUP BY 1",
    "user_features": USERS + f"""
        SELECT user_id, item_category_count, active_days, last_behavior_time,
          days_since_last_behavior, {shown(DOUBLES)}, recent_7d_buy FROM users""",
    "stored_user_features": STORED + f"SELECT {ROW} FROM stored",
    "user_rows_of_events": STORED + f"SELECT {ROW} FROM stored",
    "trailing_counts": LOG + SEQUENCED + f"SELECT {KEY}, {PV_COUNTS} FROM sequenced",
    "trailing_behavior_counts": LOG + SEQUENCED + f"SELECT {KEY}, {BEHAVIOR_COUNTS} FROM sequenced",
    "time_since_last": LOG + SEQUENCED + f"SELECT {KEY}, time_since_last_behavior FROM sequenced",
    "trailing_cut_histories": LOG + SEQUENCED + f"""
        SELECT {KEY}, {PV_COUNTS}, {BEHAVIOR_COUNTS}, time_since_last_behavior FROM sequenced""",
    "event_features": EVENT_FEATURES
    + f"SELECT {shown([quoted(c) if c == 'timestamp' else c for c in FEATURED])} FROM featured",
    "event_features_cut": EVENT_FEATURES
    + f"SELECT {shown([quoted(c) if c == 'timestamp' else c for c in FEATURED])} FROM featured",
    "user_segments": STORED + f"""
        SELECT {SEGMENT} AS user_segment, count(*) AS user_count,
          CAST(round(count(*) * 100.0::DOUBLE / (SELECT count(*) FROM stored), 2) AS DOUBLE)
            AS percentage
        FROM stored GROUP BY 1""",
    "summary_activity": STORED + """
        SELECT count(*) AS total_users, min(active_days) AS min_active_days,
          max(active_days) AS max_active_days, round(avg(active_days), 6) AS avg_active_days,
          count(CASE WHEN active_days = 1 THEN 1 END) AS single_day_users,
          count(CASE WHEN active_days >= 5 THEN 1 END) AS high_active_users
        FROM stored""",
    "summary_purchase": STORED + """
        SELECT count(CASE WHEN buy_ratio > 0 THEN 1 END) AS buyers,
          count(CASE WHEN buy_ratio = 0 THEN 1 END) AS non_buyers,
          round(avg(buy_ratio), 6) AS avg_buy_ratio, round(max(buy_ratio), 6) AS max_buy_ratio
        FROM stored""",
    "query_by_user": STORED + f"SELECT {ROW} FROM stored WHERE user_id = 7",
    "query_range": STORED + f"""
        SELECT {ROW} FROM stored WHERE active_days >= 3 AND active_days <= 20
          AND buy_ratio >= 0.1 AND buy_ratio <= 0.4""",
    "query_fields": STORED + f"SELECT {shown(['buy_ratio', 'active_days'])} FROM stored",
    "query_topn": STORED + f"""
        SELECT {ROW} FROM (SELECT * FROM stored ORDER BY buy_ratio DESC, user_id LIMIT 10)""",
    "query_page": STORED + f"""
        SELECT {ROW} FROM (SELECT * FROM stored ORDER BY active_days, user_id LIMIT 20 OFFSET 5)""",
    "query_deep_page": STORED + f"""
        SELECT {ROW} FROM (SELECT * FROM stored ORDER BY buy_ratio DESC, user_id LIMIT 20 OFFSET 70)""",
    "top_active_users": STORED + """
        SELECT user_id, CAST(active_days AS DOUBLE) AS active_days FROM stored
        ORDER BY active_days DESC, user_id LIMIT 10""",
    "cohort_low_conversion": STORED + f"""
        SELECT {ROW} FROM stored WHERE active_days >= 10 AND buy_ratio <= 0.2""",
    "cohort_high_intent": STORED + f"SELECT {ROW} FROM stored WHERE buy_ratio >= 0.3",
    "feature_upsert": UPSERTED,
    "feature_upsert_stored": UPSERTED,
    "cells_head_stored": TWO_LOADS + ", cells AS (" + MERGED_CELLS + """)
        SELECT * FROM cells
        WHERE row_key IN (SELECT CAST(user_id AS VARCHAR) AS k FROM merged ORDER BY k LIMIT 5)""",
    "store_verify": STORED + f"""
        SELECT (SELECT count(*) FROM stored) AS total_rows, {ROW}
        FROM (SELECT * FROM stored ORDER BY active_days DESC, user_id LIMIT 5)""",
    "cells_encode": CELLS + 'SELECT row_key, "column", round(value, 6) AS value FROM cells',
    "cells_merge": TWO_LOADS + MERGED_CELLS,
    "cells_decode": STORED
    + f"SELECT CAST(user_id AS VARCHAR) AS user_id, {shown(STORED_COLUMNS)} FROM stored",
    "cells_numeric": STORED + """
        SELECT CAST(user_id AS VARCHAR) AS user_id, CAST(active_days AS DOUBLE) AS active_days,
          CAST(item_category_count AS DOUBLE) AS item_category_count,
          round(buy_ratio, 6) AS buy_ratio, round(cart2buy_rate, 6) AS cart2buy_rate
        FROM stored""",
    "cells_head": CELLS + """
        SELECT row_key, "column", round(value, 6) AS value FROM cells
        WHERE row_key IN (SELECT CAST(user_id AS VARCHAR) AS k FROM stored ORDER BY k LIMIT 5)""",
    "query_cells": STORED + f"""
        SELECT CAST(user_id AS VARCHAR) AS user_id,
          {shown(['active_days', 'buy_ratio', 'recent_7d_buy'])}
        FROM (SELECT * FROM stored WHERE active_days >= 5 AND buy_ratio <= 0.35
              ORDER BY buy_ratio DESC, CAST(user_id AS VARCHAR) LIMIT 25 OFFSET 3)""",
    "query_cells_keys": STORED + """
        SELECT CAST(user_id AS VARCHAR) AS user_id FROM stored
        ORDER BY CAST(user_id AS VARCHAR) LIMIT 30""",
    "cells_families": STORED + f"""
        SELECT CAST(user_id AS VARCHAR) AS user_id, {shown([c for c in STORED_COLUMNS if c != 'active_days'])},
          CAST(active_days + CASE WHEN user_id % 3 = 0 THEN 100 ELSE 0 END AS INTEGER) AS active_days
        FROM stored""",
    "query_cells_by_qualifier": STORED + """
        SELECT CAST(user_id AS VARCHAR) AS user_id, CAST(vip AS VARCHAR) AS vip,
          CAST(days AS VARCHAR) AS active_days
        FROM (SELECT user_id, active_days + CASE WHEN user_id % 3 = 0 THEN 100 ELSE 0 END AS days,
                CASE WHEN user_id % 4 = 0 THEN user_id * 7 % 11 END AS vip FROM stored)
        WHERE days >= 5 ORDER BY coalesce(vip, 0) DESC, CAST(user_id AS VARCHAR) LIMIT 40""",
    "query_cells_all": STORED + """
        SELECT CAST(user_id AS VARCHAR) AS row_key, unnest(
          [{'q': 'active_days', 'v': CAST(active_days AS DOUBLE)},
           {'q': 'buy_ratio', 'v': round(buy_ratio, 6)},
           {'q': 'vip', 'v': 1.0::DOUBLE}], recursive := true)
        FROM stored WHERE active_days >= 5 AND user_id % 2 = 0""",
    "query_cells_by_user": STORED + f"""
        SELECT CAST(user_id AS VARCHAR) AS user_id, {shown(STORED_COLUMNS)}
        FROM stored WHERE user_id = 7""",
    "profile_describe": describe(),
    "profile_schema": schema_rows(),
    "feature_sample": SAMPLED
    + f"SELECT {shown([quoted(c) if c == 'timestamp' else c for c in FEATURED])} FROM sampled",
    "profile_quartiles": quartiles(),
    "dist_buy_ratio_sample": EVENT_FEATURES + histogram("featured", "buy_ratio", 50),
    "activity_levels": STORED + LEVELS + """
        SELECT l.position, l.level, count(u.user_id) AS user_count,
          round(count(u.user_id) * 100.0::DOUBLE / (SELECT count(*) FROM stored), 6) AS percentage
        FROM levels l LEFT JOIN leveled u ON l.level = u.level GROUP BY l.position, l.level""",
    "dist_active_days": STORED + """
        SELECT b.bin, count(s.user_id) AS count
        FROM range((SELECT max(active_days) + 1 FROM stored)) b(bin)
        LEFT JOIN stored s ON s.active_days = b.bin GROUP BY b.bin""",
    "dist_buy_ratio": STORED + histogram("stored", "buy_ratio", 20),
    "dist_buy_ratio_events": EVENT_FEATURES + histogram("featured", "buy_ratio", 50),
    "ecdf_interval": cumulative("avg_behavior_interval"),
    "box_interval": box_stats("avg_behavior_interval"),
    "ecdf_buy_ratio": cumulative("buy_ratio"),
    "crosstab_days_items": STORED + """
        SELECT CAST(active_days AS DOUBLE) AS active_days,
          CAST(item_category_count AS DOUBLE) AS item_category_count, count(*) AS count
        FROM stored GROUP BY 1, 2""",
    "crosstab_axis_days": STORED + """
        SELECT CAST(active_days AS DOUBLE) AS value, count(*) AS count FROM stored GROUP BY 1""",
    "scatter_days_items": STORED + """
        SELECT CAST(active_days AS DOUBLE) AS active_days,
          CAST(item_category_count AS DOUBLE) AS item_category_count FROM stored""",
    "pair_features": STORED + """
        SELECT CAST(active_days AS DOUBLE) AS active_days,
          CAST(item_category_count AS DOUBLE) AS item_category_count,
          round(buy_ratio, 6) AS buy_ratio, round(cart2buy_rate, 6) AS cart2buy_rate
        FROM stored""",
    "box_by_activity": box_stats("buy_ratio"),
    "box_outliers": STORED + boxes("buy_ratio") + """
        SELECT user_id, level, round(value, 6) AS value FROM fenced WHERE NOT inside""",
    "kde_active_days": STORED + density(series("active_days")),
    "kde_buy_ratio": STORED + density(series("buy_ratio")),
    "kde_by_group": STORED + LEVELS + density(
        "SELECT level AS series, buy_ratio AS value FROM leveled", points=100, cut=2
    ),
    "kde_pair_features": STORED + density(
        series("active_days", "item_category_count", "buy_ratio", "cart2buy_rate"), cut=3
    ),
    "ingest_buckets": LOG + 'SELECT user_id, item_id, category_id, behavior_type, "timestamp" FROM raw',
}
