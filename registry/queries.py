"""Every operator as a query over a folder of the driver's tables.

Doubles are rounded and times shown as text, so that results can be compared
with another engine value by value.
"""

from footfall.functions.expressions import numeric_rows
from footfall.operators import distributions as d
from footfall.operators.cells import decode_cells, decode_numbers, encode_cells, head_cells, merge_cells
from footfall.operators.clean import behavior_counts, clean_events, validation_counts
from footfall.operators.event_features import event_features, trailing_features
from footfall.operators.upsert import upsert_users
from footfall.operators.user_features import stored_rows, user_features, users_of_event_features
from footfall.plans import feature_query, figures, paging, profile, summary
from footfall.schema import EVENT_KEY, STORED_FEATURES
from footfall.session import scratch_dir
from footfall.sources import user_table
from footfall.sources.behavior_log import read_raw_log
from footfall.sources.event_table import raw_log_from_events, read_events
from footfall.streaming import ingest

AS_OF = "2024-01-31"

# The first load of the upsert query has the events before this moment, the
# second one all later events.
LOADS_SPLIT_AT = 1704153600  # 2024-01-02 00:00:00


def comparable(df, digits=6):
    shown = {"double": f"round(`{{0}}`, {digits})", "timestamp": "date_format(`{0}`, 'yyyy-MM-dd HH:mm:ss')"}
    return df.selectExpr(
        *[f"{shown.get(kind, '`{0}`').format(name)} AS `{name}`" for name, kind in df.dtypes]
    )


def cleaned(spark, folder):
    return clean_events(read_events(spark, folder))


def users(spark, folder):
    return user_features(cleaned(spark, folder), AS_OF)


def stored(spark, folder):
    return stored_rows(users(spark, folder))


def cells(spark, folder):
    return encode_cells(stored(spark, folder))


def featured(spark, folder, **options):
    raw = read_events(spark, folder)
    return event_features(clean_events(raw), AS_OF, **options)


def trailing(spark, folder, *columns, **options):
    raw = read_events(spark, folder)
    rows = trailing_features(clean_events(raw), **options)
    return rows.select(*EVENT_KEY, *columns)


PV_COUNTS = ["pv_count_1d", "pv_count_7d", "pv_count_30d"]
BEHAVIOR_COUNTS = ["item_pv_count_1d", "item_cart_count_1d", "item_buy_count_1d"]


def _two_loads(events):
    first = user_features(events.filter(f"timestamp < {LOADS_SPLIT_AT}"), "2024-01-30")
    second = user_features(events.filter(f"timestamp >= {LOADS_SPLIT_AT}"), AS_OF)
    return stored_rows(first), stored_rows(second)


def feature_upsert(spark, folder):
    events = cleaned(spark, folder)
    first, second = _two_loads(events)
    table = upsert_users(None, first, "2024-01-30 00:00:00")
    return upsert_users(table, second, "2024-01-31 00:00:00")


def stored_upsert(spark, folder):
    """The same two loads through the stored table."""
    path = scratch_dir(spark, "users")
    for rows, moment in zip(_two_loads(cleaned(spark, folder)), ("30", "31"), strict=True):
        user_table.load_users(spark, rows, path, f"2024-01-{moment} 00:00:00")
    return user_table.read_table(spark, path)


def stored_cells(spark, folder):
    """A cell table after two loads."""
    path = scratch_dir(spark, "cells")
    for rows in _two_loads(cleaned(spark, folder)):
        user_table.load_cells(spark, rows, path, "f")
    return path


def cells_merge(spark, folder):
    events = cleaned(spark, folder)
    first, second = _two_loads(events)
    table = merge_cells(None, encode_cells(first))
    return _cells_as_numbers(merge_cells(table, encode_cells(second)))


def _cells_as_numbers(rows):
    return rows.selectExpr("row_key", "column", "try_cast(value AS double) AS value")


def _typed(decoded):
    kinds = {c: t for c, t in STORED_FEATURES.items() if c in decoded.columns}
    return decoded.selectExpr(
        "user_id", *[f"try_cast({c} AS {t}) AS {c}" for c, t in kinds.items()]
    )


def _sampled(spark, folder):
    return profile.sample(featured(spark, folder), 1000)


def ingest_buckets(spark, folder):
    """Land the whole log through a stream, then read it back as a raw log."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    path = f"{folder}/events.parquet"
    schema = spark.read.parquet(path).schema
    # A pattern, because a stream reads a plain path only if it is a folder.
    stream = spark.readStream.schema(schema).parquet(f"{folder}/event[s].parquet")
    lines = ingest.as_lines(raw_log_from_events(stream))
    work = scratch_dir(spark, "landing")
    ingest.land(
        lines, f"{work}/lines", f"{work}/checkpoint", trigger={"availableNow": True}
    ).awaitTermination()
    return read_raw_log(spark, f"{work}/lines")


def _deep_page(spark, folder):
    """A page past the first rows, found by ranges whatever the size of the table."""
    shipped = paging.SHALLOW, paging.RANGE_ROWS
    paging.SHALLOW, paging.RANGE_ROWS = 5, 20
    try:
        return feature_query.query_table(
            stored(spark, folder), order_by="buy_ratio", desc=True, limit=20, offset=70
        )
    finally:
        paging.SHALLOW, paging.RANGE_ROWS = shipped


def _with_extra_cells(spark, folder):
    """Cells of even users, one qualifier of which the engine does not know."""
    known = cells(spark, folder).filter("column IN ('f:active_days', 'f:buy_ratio')")
    even = known.filter("row_key % 2 = 0")
    more = even.filter("column = 'f:active_days'").selectExpr("row_key", "'f:vip' AS column", "'1' AS value")
    found = feature_query.query_cells(even.unionByName(more), min_active_days=5, top_n=None)
    return found.selectExpr("user_id AS row_key", "explode(cells) AS (q, v)").selectExpr(
        "row_key", "q", "double(v) AS v"
    )


def _two_families(spark, folder):
    """Cells of family f, and of g, which is later, other values and a qualifier of its own."""
    own = cells(spark, folder)
    days = own.filter("column = 'f:active_days'")
    other = days.filter("int(row_key) % 3 = 0").selectExpr(
        "row_key", "'g:active_days' AS column", "string(int(value) + 100) AS value"
    )
    vip = days.filter("int(row_key) % 4 = 0").selectExpr(
        "row_key", "'g:vip' AS column", "string(int(row_key) * 7 % 11) AS value"
    )
    return own.unionByName(other).unionByName(vip)


QUERIES = {
    # cleaning
    "clean_events": cleaned,
    "validate_counts": lambda s, f: validation_counts(cleaned(s, f)),
    "behavior_counts": lambda s, f: behavior_counts(cleaned(s, f)),
    # features
    "user_features": lambda s, f: comparable(users(s, f)),
    "stored_user_features": lambda s, f: comparable(stored(s, f)),
    "user_rows_of_events": lambda s, f: comparable(
        stored_rows(users_of_event_features(featured(s, f)))
    ),
    "trailing_counts": lambda s, f: trailing(s, f, *PV_COUNTS),
    "trailing_behavior_counts": lambda s, f: trailing(s, f, *BEHAVIOR_COUNTS),
    "time_since_last": lambda s, f: trailing(s, f, "time_since_last_behavior"),
    "trailing_cut_histories": lambda s, f: trailing(
        s, f, *PV_COUNTS, *BEHAVIOR_COUNTS, "time_since_last_behavior", crowded_day=2
    ),
    "event_features": lambda s, f: comparable(featured(s, f)),
    "event_features_cut": lambda s, f: comparable(featured(s, f, crowded_day=2)),
    # summary
    "user_segments": lambda s, f: summary.user_segments(stored(s, f)),
    "summary_activity": lambda s, f: comparable(summary.activity_summary(stored(s, f))),
    "summary_purchase": lambda s, f: comparable(summary.purchase_summary(stored(s, f))),
    # feature queries on the user table
    "query_by_user": lambda s, f: comparable(feature_query.query_table(stored(s, f), user_id="7")),
    "query_range": lambda s, f: comparable(
        feature_query.query_table(
            stored(s, f),
            top_n=None,
            min_active_days=3,
            max_active_days=20,
            min_buy_ratio=0.1,
            max_buy_ratio=0.4,
        )
    ),
    "query_fields": lambda s, f: comparable(
        feature_query.query_table(stored(s, f), top_n=None, fields=["buy_ratio", "active_days"])
    ),
    "query_topn": lambda s, f: comparable(
        feature_query.query_table(stored(s, f), order_by="buy_ratio", desc=True)
    ),
    "query_page": lambda s, f: comparable(
        feature_query.query_table(stored(s, f), order_by="active_days", limit=20, offset=5)
    ),
    "query_deep_page": lambda s, f: comparable(_deep_page(s, f)),
    "top_active_users": lambda s, f: comparable(feature_query.top_active_users(stored(s, f))),
    "cohort_low_conversion": lambda s, f: comparable(
        feature_query.low_conversion_users(stored(s, f), min_active_days=10, max_buy_ratio=0.2)
    ),
    "cohort_high_intent": lambda s, f: comparable(
        feature_query.high_intent_users(stored(s, f), min_buy_ratio=0.3)
    ),
    # stores
    "feature_upsert": lambda s, f: comparable(feature_upsert(s, f)),
    "feature_upsert_stored": lambda s, f: comparable(stored_upsert(s, f)),
    "cells_head_stored": lambda s, f: comparable(
        _cells_as_numbers(user_table.read_head(s, stored_cells(s, f)))
    ),
    "store_verify": lambda s, f: comparable(feature_query.verify_table(stored(s, f))),
    "cells_encode": lambda s, f: comparable(_cells_as_numbers(cells(s, f))),
    "cells_merge": lambda s, f: comparable(cells_merge(s, f)),
    "cells_decode": lambda s, f: comparable(_typed(decode_cells(cells(s, f)))),
    "cells_numeric": lambda s, f: comparable(
        decode_numbers(cells(s, f), ["user_id", *figures.PAIR_COLUMNS])
    ),
    "cells_head": lambda s, f: comparable(_cells_as_numbers(head_cells(cells(s, f)))),
    "query_cells": lambda s, f: comparable(
        _typed(
            feature_query.query_cells(
                cells(s, f),
                min_active_days=5,
                max_buy_ratio=0.35,
                order_by="buy_ratio",
                desc=True,
                fields=["active_days", "buy_ratio", "recent_7d_buy"],
                limit=25,
                offset=3,
            )
        )
    ),
    "query_cells_by_user": lambda s, f: comparable(
        _typed(
            feature_query.query_cells(
                cells(s, f), user_id="7", min_active_days=99, fields=list(STORED_FEATURES)
            )
        )
    ),
    "query_cells_keys": lambda s, f: feature_query.query_cells(
        cells(s, f), fields=["user_id", "nope"], top_n=None, limit=30
    ),
    "cells_families": lambda s, f: comparable(_typed(decode_cells(_two_families(s, f)))),
    "query_cells_by_qualifier": lambda s, f: feature_query.query_cells(
        _two_families(s, f), min_active_days=5, order_by="vip", desc=True, fields=["vip", "active_days"], limit=40
    ),
    "query_cells_all": lambda s, f: comparable(_with_extra_cells(s, f)),
    # profile
    "profile_describe": lambda s, f: comparable(profile.describe(featured(s, f)), 3),
    "profile_schema": lambda s, f: profile.schema_rows(featured(s, f)),
    "feature_sample": lambda s, f: comparable(_sampled(s, f)),
    "profile_quartiles": lambda s, f: comparable(profile.quartiles(featured(s, f)), 3),
    "dist_buy_ratio_sample": lambda s, f: comparable(
        d.equal_width_histogram(featured(s, f), "buy_ratio", 50)
    ),
    # distributions
    "activity_levels": lambda s, f: comparable(d.activity_levels(stored(s, f))),
    "dist_active_days": lambda s, f: d.integer_histogram(stored(s, f), "active_days"),
    "dist_buy_ratio": lambda s, f: comparable(d.equal_width_histogram(stored(s, f), "buy_ratio", 20)),
    "dist_buy_ratio_events": lambda s, f: comparable(
        d.equal_width_histogram(
            user_features(cleaned(s, f), AS_OF, with_events=True), "buy_ratio", 50, weight="events"
        )
    ),
    "ecdf_interval": lambda s, f: comparable(
        d.cumulative_shares(stored(s, f), "avg_behavior_interval")
    ),
    "box_interval": lambda s, f: comparable(d.box_stats(stored(s, f), "avg_behavior_interval")),
    "ecdf_buy_ratio": lambda s, f: comparable(d.cumulative_shares(stored(s, f), "buy_ratio")),
    "crosstab_days_items": lambda s, f: comparable(
        d.crosstab(stored(s, f), "active_days", "item_category_count")
    ),
    "crosstab_axis_days": lambda s, f: comparable(
        d.crosstab_axis(stored(s, f), "active_days", "item_category_count")
    ),
    "scatter_days_items": lambda s, f: comparable(
        d.scatter(stored(s, f), "active_days", "item_category_count")
    ),
    "pair_features": lambda s, f: comparable(numeric_rows(stored(s, f), figures.PAIR_COLUMNS)),
    "box_by_activity": lambda s, f: comparable(d.box_stats(stored(s, f), "buy_ratio")),
    "box_outliers": lambda s, f: comparable(d.box_outliers(stored(s, f), "buy_ratio")),
    "kde_active_days": lambda s, f: comparable(figures.active_days_density(stored(s, f))),
    "kde_buy_ratio": lambda s, f: comparable(figures.buy_ratio_density(stored(s, f))),
    "kde_by_group": lambda s, f: comparable(d.violin_densities(stored(s, f), "buy_ratio")),
    "kde_pair_features": lambda s, f: comparable(figures.pair_densities(stored(s, f))),
    # stream
    "ingest_buckets": ingest_buckets,
}
