import pytest
from pyspark.sql import functions as F

from footfall.operators.cells import encode_cells
from footfall.plans import paging
from footfall.plans.feature_query import query_cells, query_table
from tests.test_store import SCHEMA, user


@pytest.fixture
def small_ranges(monkeypatch):
    monkeypatch.setattr(paging, "SHALLOW", 10)
    monkeypatch.setattr(paging, "RANGE_ROWS", 50)
    monkeypatch.setattr(paging, "SAMPLE", 100)


@pytest.fixture(scope="module")
def table(spark):
    # A third of all rows has one key; some are null or not a number.
    key = F.expr("CASE WHEN id % 3 = 0 THEN 7D WHEN id % 50 = 1 THEN NULL WHEN id % 50 = 2 THEN double('NaN') ELSE double(hash(id) % 40) END")
    return spark.range(0, 3000, 1, 5).select(F.col("id").alias("user_id"), key.alias("k"))


@pytest.mark.parametrize("desc", [False, True])
@pytest.mark.parametrize("offset", [11, 1500, 2995, 3000])
def test_deep_pages_equal_the_sorted_rows(table, small_ranges, desc, offset):
    order = [("k", desc), ("user_id", False)]
    every = [r.user_id for r in table.orderBy(*paging.sort_keys(order)).collect()]
    assert [r.user_id for r in paging.page(table, order, offset, 20).collect()] == every[offset : offset + 20]
    assert [r.user_id for r in paging.page(table, order, offset).collect()] == every[offset:]


def test_equal_rows_are_skipped_by_number(spark, small_ranges):
    rows = spark.range(400).selectExpr("1 AS k", "5 AS user_id")
    assert paging.page(rows, [("k", False), ("user_id", False)], 300, 500).count() == 100


def test_only_a_range_is_sorted(table, small_ranges, monkeypatch):
    sorted_rows = []
    whole = paging.before

    def seen(rows, order, bound):
        sorted_rows.append(rows)
        return whole(rows, order, bound)

    monkeypatch.setattr(paging, "before", seen)
    paging.row_at(table, [("k", False), ("user_id", False)], 1500)
    assert sorted_rows[-1].count() <= 50 < sorted_rows[0].count()


def test_tasks_keep_the_rows_of_the_page_only(table, small_ranges):
    page = paging.page(table, [("k", False), ("user_id", False)], 1500, 20)
    assert "TakeOrderedAndProject(limit=20" in page._jdf.queryExecution().executedPlan().toString()


def test_both_forms(spark, small_ranges):
    users = spark.createDataFrame([user(i, i * 7 % 11, 0.1) for i in range(300)], SCHEMA)
    by_days = sorted(range(300), key=lambda i: (-(i * 7 % 11), i))
    got = query_table(users, order_by="active_days", desc=True, limit=7, offset=200)
    assert [r.user_id for r in got.collect()] == by_days[200:207]
    as_text = sorted(range(300), key=lambda i: (-(i * 7 % 11), str(i)))
    got = query_cells(encode_cells(users), order_by="active_days", desc=True, limit=7, offset=200)
    assert [int(r.user_id) for r in got.collect()] == as_text[200:207]
