import pytest

from footfall.operators.cells import encode_cells
from footfall.plans import summary
from footfall.plans.feature_query import (
    high_intent_users,
    low_conversion_users,
    query_cells,
    query_table,
    top_active_users,
    verify_table,
)
from tests.conftest import rows
from tests.test_store import SCHEMA, user


@pytest.fixture(scope="module")
def users(spark):
    given = [(1, 3, 0.1), (2, 8, 0.4), (3, 8, 0.0), (10, 1, 0.4), (11, 20, 0.2)]
    return spark.createDataFrame([user(*u) for u in given], SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def cells(users):
    return encode_cells(users)


def ids(df):
    return [int(r.user_id) for r in df.collect()]


def test_table_defaults_to_the_first_ten(users):
    assert ids(query_table(users)) == [1, 2, 3, 10, 11]
    assert ids(query_table(users, top_n=2)) == [1, 2]


def test_offset_needs_limit_in_table_form_only(users, cells):
    assert ids(query_table(users, offset=2, top_n=2)) == [1, 2]
    assert ids(query_cells(cells, offset=2, top_n=2)) == [11, 2]


def test_limit_wins_over_top_n(users, cells):
    assert ids(query_table(users, limit=3, offset=1, top_n=1)) == [2, 3, 10]
    assert ids(query_cells(cells, limit=3, top_n=1)) == [1, 10, 11]


def test_lookup_applies_filters_in_table_form_only(users, cells):
    assert ids(query_table(users, user_id="1", min_active_days=99)) == []
    assert ids(query_cells(cells, user_id="1", min_active_days=99)) == [1]
    assert ids(query_table(users, user_id=1)) == [1]
    assert ids(query_table(users, user_id="nobody")) == []
    assert ids(query_cells(cells, user_id=77)) == []


@pytest.mark.parametrize("form", ["table", "cells"])
def test_ranges_are_inclusive(users, cells, form):
    query = (lambda **o: query_table(users, **o)) if form == "table" else (
        lambda **o: query_cells(cells, **o)
    )
    assert sorted(ids(query(min_active_days=3, max_active_days=8))) == [1, 2, 3]
    assert sorted(ids(query(min_buy_ratio=0.2, max_buy_ratio=0.4))) == [2, 10, 11]
    assert sorted(ids(query(min_active_days=8, max_buy_ratio=0.3))) == [3, 11]


def test_order_and_ties(users, cells):
    assert ids(query_table(users, order_by="active_days")) == [10, 1, 2, 3, 11]
    assert ids(query_table(users, order_by="active_days", desc=True)) == [11, 2, 3, 1, 10]
    assert ids(query_cells(cells, order_by="buy_ratio")) == [3, 1, 11, 10, 2]
    assert ids(query_cells(cells, order_by="buy_ratio", desc=True)) == [10, 2, 11, 1, 3]
    assert ids(query_cells(cells, order_by="user_id")) == [1, 2, 3, 10, 11]
    assert ids(query_cells(cells, order_by="no_such_field", desc=True)) == [1, 10, 11, 2, 3]


def test_fields(users, cells):
    table = query_table(users, fields=["buy_ratio", "active_days"], order_by="user_id", top_n=1)
    assert table.columns == ["buy_ratio", "active_days"] and rows(table) == [(0.1, 3)]
    found = query_cells(cells, fields=["buy_ratio", "unknown"], order_by="active_days", top_n=1)
    assert found.columns == ["user_id", "buy_ratio"] and rows(found) == [("10", "0.4")]
    with pytest.raises(Exception, match="unknown"):
        query_table(users, fields=["unknown"]).collect()


def test_field_names_are_not_sql(users):
    with pytest.raises(Exception):
        query_table(users, fields=["1 AS x"]).collect()


def test_any_qualifier_is_shown_and_sorted_by(spark, cells):
    more = spark.createDataFrame(
        [("1", "f:vip", "3"), ("11", "f:vip", "20"), ("2", "f:vip", "oops"), ("3", "f:it's `odd`", "x")],
        "row_key string, column string, value string",
    )
    both = cells.unionByName(more)
    found = query_cells(both, fields=["vip", "buy_ratio"], order_by="vip", desc=True, top_n=3)
    assert found.columns == ["user_id", "vip", "buy_ratio"]
    assert [r[:2] for r in rows(found)] == [("11", "20"), ("1", "3"), ("10", None)]
    assert ids(query_cells(both, order_by="vip", desc=True)) == [11, 1, 10, 2, 3]
    assert rows(query_cells(both, user_id="3", fields=["it's `odd`"])) == [("3", "x")]


def test_the_last_column_of_a_qualifier_counts(spark):
    cells = spark.createDataFrame(
        [("1", "f:active_days", "4"), ("1", "g:active_days", "9"), ("1", "e:active_days", "50"), ("1", "f:vip", "1"),
         ("2", "g:active_days", "7"), ("2", "f:active_days", "8"), ("3", "g:active_days", "oops"), ("3", "f:active_days", "99")],
        "row_key string, column string, value string",
    )
    found = query_cells(cells, fields=["active_days"], order_by="active_days", desc=True)
    assert rows(found) == [("1", "9"), ("2", "7"), ("3", "oops")]
    assert ids(query_cells(cells, min_active_days=8)) == [1]
    every = {r.user_id: r.cells for r in query_cells(cells).collect()}
    assert every == {"1": {"active_days": "9", "vip": "1"}, "2": {"active_days": "7"}, "3": {"active_days": "oops"}}


def test_cells_without_a_value_count_as_zero(spark):
    cells = spark.createDataFrame(
        [("1", "f:active_days", "4"), ("2", "f:buy_ratio", "oops")],
        "row_key string, column string, value string",
    )
    assert ids(query_cells(cells, max_active_days=0)) == [2]
    assert ids(query_cells(cells, max_buy_ratio=0)) == [1, 2]
    assert ids(query_cells(cells, order_by="active_days", desc=True)) == [1, 2]


def test_everything_without_limits(users, cells):
    assert sorted(ids(query_table(users, top_n=None))) == [1, 2, 3, 10, 11]
    assert sorted(ids(query_cells(cells, top_n=None))) == [1, 2, 3, 10, 11]


def test_cohorts(users):
    assert ids(low_conversion_users(users, min_active_days=3, max_buy_ratio=0.2)) == [11, 3, 1]
    assert ids(high_intent_users(users, min_buy_ratio=0.2)) == [2, 10, 11]
    assert ids(high_intent_users(users, min_buy_ratio=0.2, top_n=1)) == [2]


def test_top_users_and_verification(users):
    assert rows(top_active_users(users, 2)) == [(11, 20.0), (2, 8.0)]
    checked = verify_table(users, 2).collect()
    assert [(r.total_rows, r.user_id) for r in checked] == [(5, 11), (5, 2)]


def test_summaries(users):
    assert rows(summary.activity_summary(users)) == [(5, 1, 20, 8.0, 1, 3)]
    assert rows(summary.purchase_summary(users)) == [(4, 1, pytest.approx(0.22), 0.4)]


def test_segments(spark):
    days = [1, 1, 2, 4, 5, 9, 10, 0, None]
    frame = spark.createDataFrame([(d,) for d in days], "active_days int")
    got = {r.user_segment: (r.user_count, r.percentage) for r in summary.user_segments(frame).collect()}
    assert got == {
        "单日用户": (2, 22.22), "低频用户": (2, 22.22), "中频用户": (2, 22.22), "高频用户": (3, 33.33),
    }


def test_segments_of_hand_fixture(cleaned):
    from footfall.operators.user_features import user_features

    got = rows(summary.user_segments(user_features(cleaned, "2024-01-09")))
    assert got == [("单日用户", 2, 66.67), ("低频用户", 1, 33.33)]
