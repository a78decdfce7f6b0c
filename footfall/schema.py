"""Schemas and fixed values shared by every module."""

from pyspark.sql.types import LongType, StringType, StructField, StructType

# The raw log layout. The log has no header, so order matters.
RAW_LOG = StructType(
    [
        StructField("user_id", LongType()),
        StructField("item_id", LongType()),
        StructField("category_id", LongType()),
        StructField("behavior_type", StringType()),
        StructField("timestamp", LongType()),
    ]
)
RAW_COLUMNS = RAW_LOG.fieldNames()

# The behaviours a cleaned log may hold, matched case-sensitively.
BEHAVIORS = ["pv", "buy", "cart", "fav"]

# Two log lines that agree here are copies of one event.
EVENT_KEY = ["user_id", "item_id", "behavior_type", "timestamp"]

# Total order of one user's events (with user_id this is EVENT_KEY, so no ties).
EVENT_ORDER = ["timestamp", "item_id", "behavior_type"]

# The stored user features and their types.
STORED_FEATURES = {
    "active_days": "int",
    "days_since_last_behavior": "int",
    "pv_ratio": "double",
    "cart_ratio": "double",
    "buy_ratio": "double",
    "fav_ratio": "double",
    "cart2buy_rate": "double",
    "avg_behavior_interval": "double",
    "recent_7d_buy": "int",
    "item_category_count": "int",
}

# Columns added to a cleaned log, in output order.
EVENT_FEATURES = [
    "timestamp_ts",
    "hour",
    "day_of_week",
    "pv_count_1d",
    "pv_count_7d",
    "pv_count_30d",
    "item_pv_count_1d",
    "item_cart_count_1d",
    "item_buy_count_1d",
    "time_since_last_behavior",
    "item_category_count",
    "active_days",
    "last_behavior_time",
    "days_since_last_behavior",
    "pv_ratio",
    "cart_ratio",
    "buy_ratio",
    "fav_ratio",
    "cart2buy_rate",
    "behavior_interval",
    "avg_behavior_interval",
    "recent_7d_buy",
]

# How many events each trailing count looks at, the current one
# included. The names say days but the frames are rows.
TRAILING_EVENTS = {"pv_count_1d": 2, "pv_count_7d": 8, "pv_count_30d": 31}
