import random

import pytest

from footfall.operators.clean import clean_events
from footfall.operators.event_features import (
    event_features,
    crowded_days,
    PIECE,
    in_pieces,
    trailing_features,
)
from footfall.operators.user_features import (
    stored_rows,
    user_features,
    users_of_event_features,
)
from footfall.schema import EVENT_FEATURES, RAW_COLUMNS, RAW_LOG, STORED_FEATURES
from footfall.sources.event_table import read_events
from tests.conftest import B, rows

AS_OF = "2024-01-09"


@pytest.fixture(scope="module")
def users(cleaned):
    return user_features(cleaned, AS_OF)


@pytest.fixture(scope="module")
def events(cleaned):
    return event_features(cleaned, AS_OF)


def log(spark, lines):
    return clean_events(spark.createDataFrame(lines, RAW_LOG))


def test_user_features_of_hand_fixture(users):
    columns = ["user_id", *STORED_FEATURES]
    assert sorted(rows(users, *columns)) == [
        (1, 2, 7, 0.25, 0.25, 0.25, 0.25, 1.0, 28800.0, 0, 3),
        (2, 1, 6, 1.0, 0.0, 0.0, 0.0, 0.0, None, 0, 1),
        (3, 1, -2, 0.0, 0.0, 1.0, 0.0, 0.0, None, 1, 1),
    ]


def test_stored_rows_replace_nulls_and_narrow(users):
    stored = stored_rows(users)
    assert dict(stored.dtypes) == {"user_id": "bigint", **STORED_FEATURES}
    assert {r.user_id: r.avg_behavior_interval for r in stored.collect()}[2] == 0.0


def test_event_features_of_hand_fixture(events):
    first = events.filter("user_id = 1").orderBy("timestamp", "item_id", "behavior_type")
    got = rows(
        first, "hour", "day_of_week", "pv_count_1d", "pv_count_7d", "pv_count_30d",
        "item_pv_count_1d", "item_cart_count_1d", "item_buy_count_1d",
        "time_since_last_behavior", "behavior_interval",
    )
    assert got == [
        (0, 2, 1, 1, 1, 1, 0, 0, None, None),
        (0, 2, 2, 2, 2, 1, 1, 0, 0, 0),
        (1, 2, 2, 3, 3, 0, 1, 1, 3600, 3600),
        (0, 3, 2, 4, 4, 0, 0, 1, 82800, 82800),
    ]


def test_event_feature_columns(events):
    assert events.columns == [*RAW_COLUMNS, "datetime", *EVENT_FEATURES]
    assert dict(events.dtypes)["timestamp_ts"] == "timestamp"


def test_event_rows_reduce_to_user_rows(events, users):
    assert sorted(rows(stored_rows(users_of_event_features(events)))) == sorted(
        rows(stored_rows(users))
    )


def test_trailing_counts_are_rows_not_days(spark):
    many = log(spark, [(1, 5, 1, "pv", B + i) for i in range(40)])
    got = rows(
        trailing_features(many).orderBy("timestamp"), "pv_count_1d", "pv_count_7d", "pv_count_30d"
    )
    assert got == [(min(i, 2), min(i, 8), min(i, 31)) for i in range(1, 41)]


def test_default_day_is_today(cleaned):
    got = user_features(cleaned).selectExpr(
        "days_since_last_behavior = datediff(current_date(), to_date(last_behavior_time)) AS same"
    )
    assert set(rows(got)) == {(True,)}


def test_ratios_sum_to_one(spark, small):
    users = user_features(clean_events(read_events(spark, small)), "2024-01-31")
    sums = rows(users.selectExpr("pv_ratio + cart_ratio + buy_ratio + fav_ratio AS s"))
    assert all(abs(s - 1) < 1e-12 for (s,) in sums)


def test_mean_gap_equals_mean_of_gaps(spark, small):
    cleaned = clean_events(read_events(spark, small))
    closed = dict(rows(user_features(cleaned, AS_OF), "user_id", "avg_behavior_interval"))
    mean = trailing_features(cleaned).groupBy("user_id").agg({"time_since_last_behavior": "avg"})
    for user, value in rows(mean):
        assert value is None and closed[user] is None or abs(value - closed[user]) < 1e-6


# --- long histories ------------------------------------------------------------


def brute_force(lines):
    """Trailing features of distinct lines, one user at a time."""
    out = []
    for user in {line[0] for line in lines}:
        own = sorted((l for l in lines if l[0] == user), key=lambda l: (l[4], l[1], l[3]))
        for i, line in enumerate(own):
            pair = [l[3] for l in own[max(0, i - 1) : i + 1]]
            out.append(
                (user, line[1], line[3], line[4])
                + tuple(min(i + 1, n) for n in (2, 8, 31))
                + tuple(pair.count(b) for b in ("pv", "cart", "buy"))
                + ((line[4] - own[i - 1][4]) if i else None,)
            )
    return out


COLUMNS = [
    "user_id", "item_id", "behavior_type", "timestamp", "pv_count_1d", "pv_count_7d",
    "pv_count_30d", "item_pv_count_1d", "item_cart_count_1d", "item_buy_count_1d",
    "time_since_last_behavior",
]


def histories(kind):
    """One user with most of the lines beside a few ordinary ones."""
    rng = random.Random(kind)
    moment = {
        "even": lambda: rng.randrange(100_000),
        "one second": lambda: 0,
        "burst": lambda: rng.choice([0, 1, 2, rng.randrange(1_000_000)]),
        "two ends": lambda: rng.choice([0, 999_999]),
        "huge gap": lambda: rng.choice([rng.randrange(50), 10**9 + rng.randrange(50)]),
    }[kind]
    lines = {
        (user, rng.randrange(1000), 1, rng.choice(["pv", "cart", "buy", "fav"]), B + moment())
        for user, count in ((1, 600), (2, 20), (3, 1), (4, 45))
        for _ in range(count)
    }
    return sorted(lines)


@pytest.mark.parametrize("kind", ["even", "one second", "burst", "two ends", "huge gap"])
@pytest.mark.parametrize("crowded_day", [1, 40, 1_000_000])
def test_cut_histories_give_the_same_features(spark, kind, crowded_day):
    lines = histories(kind)
    got = trailing_features(log(spark, lines), crowded_day=crowded_day)
    key = lambda row: tuple(str(v) for v in row)
    assert sorted(rows(got, *COLUMNS), key=key) == sorted(brute_force(lines), key=key)


def test_cut_histories_keep_user_features_on_every_event(spark):
    cleaned = log(spark, histories("even"))
    whole, cut = (event_features(cleaned, AS_OF, crowded_day=n) for n in (10_000, 10))
    assert cut.exceptAll(whole).count() == whole.exceptAll(cut).count() == 0


@pytest.mark.parametrize("stray", [None, 0, B * 1000])
def test_stray_times_do_not_change_the_other_pieces(spark, stray):
    """Nine days of one user; one event at time 0 or in milliseconds."""
    from footfall.operators.event_features import CROWDED_DAY

    lines = [(1, i % 97, 1, "pv", B + i * 9 * 86400 // 20_000) for i in range(20_000)]
    lines += [] if stray is None else [(1, 5, 1, "pv", stray)]
    cleaned = log(spark, lines)
    for limit, most in ((CROWDED_DAY, 2300), (1000, 1)):
        pieces = in_pieces(cleaned, limit).groupBy("day", "second").count()
        assert max(rows(pieces, "count"))[0] <= most


def test_a_crowded_second_is_cut_into_ranges_of_items(spark):
    """One user with 100,000 events in one second beside others; no piece of twice the limit."""
    kinds = ["pv", "cart", "buy", "fav"]
    lines = [(1, i // 4 if i < 60_000 else i * i, 1, kinds[i % 4], B + 7) for i in range(100_000)]
    lines += [(1, i, 1, "pv", B + 8 + i % 50) for i in range(300)]
    lines += [(2, i, 1, "pv", B + i) for i in range(100)]
    cleaned = log(spark, lines)
    for limit in (1000, 4000):
        pieces = in_pieces(cleaned, limit).groupBy(*PIECE).count()
        sizes = {(r.user_id, r.second, r.part): r["count"] for r in pieces.collect()}
        assert max(sizes.values()) < 2 * limit and sum(sizes.values()) == len(lines)
        assert len([k for k in sizes if k[:2] == (1, B + 7)]) < 2 * 100_000 / limit
        assert sizes[2, 0, 0] == 100
    order = sorted(lines[:100_000], key=lambda x: (x[1], x[3]))
    got = trailing_features(cleaned, 1000).filter(f"user_id = 1 AND timestamp = {B + 7}")
    got = got.orderBy("item_id", "behavior_type").select(
        "item_id", "behavior_type", "pv_count_30d", "item_pv_count_1d", "time_since_last_behavior"
    )
    expected, before = [], None
    for i, (_, item, _, kind, _) in enumerate(order):
        pv = (kind == "pv") + (before == "pv")
        expected.append((item, kind, min(i + 1, 31), pv, None if before is None else 0))
        before = kind
    assert rows(got) == expected


def test_only_crowded_days_are_cut(spark):
    lines = [(1, i, 1, "pv", B + i) for i in range(200)] + [(1, 1, 1, "pv", B + 86400)]
    lines += [(2, i, 1, "pv", B + i) for i in range(100)]
    assert [r.user_id for r in crowded_days(log(spark, lines), 100).collect()] == [1]


def test_number_of_crowded_days_is_bounded(spark, monkeypatch):
    from footfall.operators import event_features as module

    monkeypatch.setattr(module, "MOST_CROWDED", 2)
    lines = [(u, i, 1, "pv", B + i) for u in range(10) for i in range(50)]
    lines += [(99, i, 1, "pv", B + i) for i in range(700)]
    assert [r.user_id for r in crowded_days(log(spark, lines), 10).collect()] == [99]


def test_features_scan_the_log_three_times(spark, tmp_path):
    log(spark, histories("even")).write.parquet(str(tmp_path / "log"))
    made = event_features(spark.read.parquet(str(tmp_path / "log")), AS_OF)
    made.write.format("noop").mode("overwrite").save()
    made.collect()
    final = made._jdf.queryExecution().executedPlan().toString()
    final = final[: final.index("Initial Plan")] if "Initial Plan" in final else final
    assert final.count("FileScan") <= 3, final
