import pytest

from footfall.operators.clean import behavior_counts, clean_events, validation_counts
from footfall.schema import RAW_LOG
from footfall.sources.behavior_log import (
    read_raw_log,
    read_sample,
    read_stage,
    write_sample,
    write_stage,
)
from tests.conftest import H1, B, rows


def test_hand_fixture_keeps_the_first_six_lines(cleaned):
    got = rows(cleaned, "user_id", "item_id", "category_id", "behavior_type", "timestamp")
    assert sorted(got) == sorted(H1[:6])


def test_datetime_is_session_time_text(cleaned):
    texts = {r.timestamp: r.datetime for r in cleaned.collect()}
    assert texts[B] == "2024-01-01 00:00:00"
    assert texts[B + 3600] == "2024-01-01 01:00:00"


def test_incomplete_copy_never_hides_a_complete_one(spark):
    lines = [(1, 11, None, "cart", B), (1, 11, 7, "cart", B), (1, 11, None, "cart", B)]
    for order in (lines, lines[::-1]):
        got = clean_events(spark.createDataFrame(order, RAW_LOG).coalesce(1))
        assert rows(got, "category_id") == [(7,)]


def test_result_does_not_depend_on_input_order(spark, raw, cleaned):
    shuffled = spark.createDataFrame(H1[::-1], RAW_LOG).repartition(5)
    assert sorted(rows(clean_events(shuffled))) == sorted(rows(cleaned))


def test_validation(cleaned):
    assert rows(validation_counts(cleaned)) == [(6, 3, 4, 2)]
    assert dict(rows(behavior_counts(cleaned))) == {"pv": 2, "buy": 2, "cart": 1, "fav": 1}


def test_empty_log(spark):
    empty = clean_events(spark.createDataFrame([], RAW_LOG))
    assert rows(empty) == []
    assert rows(validation_counts(empty)) == [(0, 0, 0, 0)]


def test_raw_csv_is_read_permissively(spark, tmp_path):
    (tmp_path / "log.csv").write_text("x,2,3,pv,100\n1,2,3,pv\n1,2,3,pv,5,extra\n")
    got = rows(read_raw_log(spark, str(tmp_path / "log.csv")))
    assert got == [(None, 2, 3, "pv", 100), (1, 2, 3, "pv", None), (1, 2, 3, "pv", 5)]


def test_landing_folder_is_read_as_a_raw_log(spark, tmp_path):
    bucket = tmp_path / "ingest_date=2024-01-01" / "ingest_hour=07"
    bucket.mkdir(parents=True)
    (bucket / "part").write_text("1,2,3,pv,5\n")
    assert rows(read_raw_log(spark, str(tmp_path))) == [(1, 2, 3, "pv", 5)]


def test_stage_is_overwritten(spark, cleaned, tmp_path):
    path = str(tmp_path / "stage")
    write_stage(cleaned, path)
    write_stage(cleaned.filter("user_id = 2"), path)
    assert read_stage(spark, path).count() == 1
    assert read_stage(spark, path).schema == cleaned.schema


def test_sample_file_round_trip(spark, cleaned, tmp_path):
    path = str(tmp_path / "sample")
    write_sample(cleaned.orderBy("timestamp").limit(3), path)
    parts = list((tmp_path / "sample").glob("part-*"))
    assert len(parts) == 1
    assert parts[0].read_text().splitlines()[0].startswith("user_id,item_id")
    again = read_sample(spark, path)
    assert dict(again.dtypes)["user_id"] == "int"
    assert again.count() == 3


@pytest.mark.parametrize("sf, users", [("0.001", 15), ("0.01", 150)])
def test_adapter_uses_every_event(spark, small, sf, users):
    from footfall.sources.event_table import read_events

    folder = small.replace("0.001", sf)
    events = spark.read.parquet(f"{folder}/events.parquet")
    log = read_events(spark, folder)
    copies = events.filter("cast(get_json_object(props, '$.k') AS int) < 5").count()
    assert log.count() == events.count() + copies
    assert log.select("user_id").distinct().count() == users
