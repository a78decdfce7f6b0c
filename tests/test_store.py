import datetime
from pathlib import Path

import pytest

from footfall.operators.cells import (
    cell_row_count,
    decode_cells,
    decode_numbers,
    encode_cells,
    head_cells,
    merge_cells,
)
from footfall.operators.upsert import upsert_users
from footfall.operators.user_features import stored_rows, user_features
from footfall.schema import STORED_FEATURES
from footfall.sources import user_table
from tests.conftest import rows

SCHEMA = "user_id bigint, " + ", ".join(f"{c} {t}" for c, t in STORED_FEATURES.items())
FIRST, SECOND = "2024-01-30 00:00:00", "2024-01-31 00:00:00"


def user(user_id, days, ratio=0.5):
    return (user_id, days, 1, 0.25, 0.25, ratio, 0.0, 1.0, 60.0, 1, 3)


@pytest.fixture(scope="module")
def batch1(spark):
    return spark.createDataFrame([user(1, 1), user(2, 2)], SCHEMA)


@pytest.fixture(scope="module")
def batch2(spark):
    return spark.createDataFrame([user(2, 20), user(3, 30)], SCHEMA)


def loaded(df):
    return {
        r.user_id: (r.active_days, r.created_at.strftime("%Y-%m-%d %H:%M:%S")) for r in df.collect()
    }


def test_upsert_replaces_inserts_and_keeps(batch1, batch2):
    table = upsert_users(upsert_users(None, batch1, FIRST), batch2, SECOND)
    assert loaded(table) == {1: (1, FIRST), 2: (20, FIRST), 3: (30, SECOND)}


def test_upsert_of_the_same_batch_changes_nothing(batch1, batch2):
    once = upsert_users(upsert_users(None, batch1, FIRST), batch2, SECOND)
    twice = upsert_users(once, batch2, "2024-02-01 00:00:00")
    assert sorted(rows(once)) == sorted(rows(twice))


def test_table_versions(spark, batch1, batch2, tmp_path):
    folder = str(tmp_path / "users")
    assert user_table.current_version(spark, folder) is None
    with pytest.raises(FileNotFoundError):
        user_table.read_table(spark, folder)
    first = user_table.load_users(spark, batch1, folder, FIRST)
    second = user_table.load_users(spark, batch2, folder, SECOND)
    assert first != second and user_table.current_version(spark, folder) == second
    assert loaded(spark.read.parquet(first)) == {1: (1, FIRST), 2: (2, FIRST)}
    assert loaded(user_table.read_table(spark, folder)) == {
        1: (1, FIRST), 2: (20, FIRST), 3: (30, SECOND),
    }
    assert user_table.read_table(spark, folder, ["buy_ratio"]).columns == ["buy_ratio"]


def test_unfinished_version_is_ignored(spark, batch1, batch2, tmp_path):
    folder = tmp_path / "users"
    user_table.load_users(spark, batch1, str(folder), FIRST)
    (folder / "version=000002").mkdir()
    assert set(loaded(user_table.read_table(spark, str(folder)))) == {1, 2}
    path = user_table.load_users(spark, batch2, str(folder), SECOND)
    assert path.endswith("version=000003")
    assert set(loaded(user_table.read_table(spark, str(folder)))) == {1, 2, 3}


def test_created_at_defaults_to_now(batch1):
    stamps = {r.created_at.date() for r in upsert_users(None, batch1).collect()}
    today = datetime.datetime.now(datetime.timezone.utc).date()
    assert all(abs((today - stamp).days) <= 1 for stamp in stamps)


# --- cells ---------------------------------------------------------------------


def test_cells_round_trip(cleaned):
    stored = stored_rows(user_features(cleaned, "2024-01-09"))
    decoded = decode_cells(encode_cells(stored))
    typed = decoded.selectExpr(
        "bigint(user_id) AS user_id", *[f"{t}({c}) AS {c}" for c, t in STORED_FEATURES.items()]
    )
    assert sorted(rows(typed)) == sorted(rows(stored))


def test_cells_are_named_by_family(batch1):
    cells = encode_cells(batch1, "g")
    assert cells.columns == ["row_key", "column", "value"]
    assert ("1", "g:active_days", "1") in rows(cells)
    assert cells.count() == 2 * len(STORED_FEATURES)
    assert rows(cell_row_count(cells)) == [(2,)]


def test_numbers_of_cells(spark):
    cells = spark.createDataFrame(
        [("1", "f:a", "1.5"), ("1", "f:b", "many"), ("2", "f:b", "2")],
        "row_key string, column string, value string",
    )
    got = decode_numbers(cells, ["user_id", "a", "b"])
    assert sorted(rows(got), key=str) == [("1", 1.5, None), ("2", None, 2.0)]


def test_row_keys_are_ordered_as_text(spark):
    users = spark.createDataFrame([user(1, 1), user(2, 1), user(10, 1)], SCHEMA)
    keys = {r.row_key for r in head_cells(encode_cells(users), 2).collect()}
    assert keys == {"1", "10"}


def test_put_replaces_cells_one_by_one(spark):
    schema = "row_key string, column string, value string"
    old = spark.createDataFrame([("1", "f:a", "1"), ("1", "f:b", "2")], schema)
    new = spark.createDataFrame([("1", "f:b", "3"), ("2", "f:a", "4")], schema)
    merged = merge_cells(merge_cells(None, old), new)
    assert sorted(rows(merged)) == [("1", "f:a", "1"), ("1", "f:b", "3"), ("2", "f:a", "4")]


def test_cell_table(spark, batch1, batch2, tmp_path):
    folder = str(tmp_path / "cells")
    user_table.load_cells(spark, batch1, folder, "f")
    user_table.load_cells(spark, batch2, folder, "f")
    days = decode_numbers(user_table.read_table(spark, folder), ["active_days"])
    assert dict(rows(days)) == {"1": 1.0, "2": 20.0, "3": 30.0}


def test_second_load_of_a_version_fails(spark, batch1, batch2, tmp_path):
    folder = str(tmp_path / "users")
    base = user_table.load_users(spark, batch1, folder, FIRST)
    user_table.load_users(spark, batch2, folder, SECOND)
    with pytest.raises(RuntimeError, match="run it again"):
        user_table._publish(spark, batch2, folder, "user_id", base)
    assert user_table.current_version(spark, folder).endswith("000002")


@pytest.mark.parametrize("first", [True, False])
def test_a_load_that_died_after_its_claim_is_finished(spark, batch1, batch2, tmp_path, monkeypatch, first):
    folder = str(tmp_path / "users")
    if not first:
        user_table.load_users(spark, batch1.limit(0), folder, FIRST)

    def die(*_):
        raise KeyboardInterrupt

    with monkeypatch.context() as patch, pytest.raises(KeyboardInterrupt):
        patch.setattr(user_table, "_place", die)
        user_table.load_users(spark, batch1, folder, FIRST)
    user_table.load_users(spark, batch2, folder, SECOND)
    assert loaded(user_table.read_table(spark, folder)) == {
        1: (1, FIRST), 2: (20, FIRST), 3: (30, SECOND),
    }


def test_a_load_that_died_before_its_claim_is_forgotten(spark, batch1, batch2, tmp_path, monkeypatch):
    folder = str(tmp_path / "users")
    user_table.load_users(spark, batch1, folder, FIRST)

    def die(*_):
        raise KeyboardInterrupt

    with monkeypatch.context() as patch, pytest.raises(KeyboardInterrupt):
        patch.setattr(user_table, "_claim", die)
        user_table._publish(spark, batch2, folder, "user_id", user_table.current_version(spark, folder))
    assert set(loaded(user_table.read_table(spark, folder))) == {1, 2}
    user_table.load_users(spark, batch2, folder, SECOND)
    assert set(loaded(user_table.read_table(spark, folder))) == {1, 2, 3}


def parts(version):
    return {path.name for path in Path(version).glob("part=*")}


def test_a_small_load_reads_and_writes_one_part(spark, batch2, tmp_path):
    folder = str(tmp_path / "users")
    first = user_table.load_users(
        spark, spark.createDataFrame([user(i, 1) for i in range(2000)], SCHEMA), folder, FIRST
    )
    assert len(parts(first)) > user_table.PARTS * 0.9
    one = batch2.where("user_id = 3")
    own = f"part={one.select(user_table._part('user_id').alias('part')).first().part}"
    # The load works although no other part can be read any more.
    held = {}
    for path in Path(first).glob("part=*/*.parquet"):
        if path.parent.name != own:
            held[path] = path.read_bytes()
            path.write_bytes(b"unreadable")
    second = user_table.load_users(spark, one, folder, SECOND)
    assert parts(second) == {own}
    for path, data in held.items():
        path.write_bytes(data)
    found = loaded(user_table.read_table(spark, folder))
    assert len(found) == 2000 and found.pop(3) == (30, FIRST)
    assert set(found.values()) == {(1, FIRST)}


def test_whole_versions(spark, batch1, batch2, tmp_path, monkeypatch):
    folder = str(tmp_path / "users")
    monkeypatch.setattr(user_table, "WHOLE_EVERY", 2)
    paths = [user_table.load_users(spark, b, folder, FIRST) for b in (batch1, batch2, batch1, batch2)]
    assert [Path(path, user_table.WHOLE).exists() for path in paths] == [True, False, True, False]
    assert set(loaded(user_table.read_table(spark, folder))) == {1, 2, 3}
    # Rows kept elsewhere replace the table: users only the folder knew are gone.
    other = upsert_users(None, batch1.where("user_id = 1"), FIRST)
    user_table.load_users(spark, batch2, folder, SECOND, stored=other)
    assert set(loaded(user_table.read_table(spark, folder))) == {1, 2, 3}
    user_table.load_users(spark, batch2, folder, SECOND, stored=other.limit(0))
    assert set(loaded(user_table.read_table(spark, folder))) == {2, 3}


def test_an_empty_table_has_its_columns(spark, batch1, tmp_path):
    folder = str(tmp_path / "users")
    user_table.load_users(spark, batch1.limit(0), folder, FIRST)
    empty = user_table.read_table(spark, folder)
    assert empty.columns == ["user_id", *STORED_FEATURES, "created_at"] and empty.count() == 0
    user_table.load_users(spark, batch1, folder, FIRST)
    assert user_table.read_table(spark, folder).schema == empty.schema
    user_table.load_cells(spark, batch1.limit(0), str(tmp_path / "cells"), "f")
    assert user_table.read_head(spark, str(tmp_path / "cells")).count() == 0


@pytest.fixture
def plain_plans(spark):
    """Scans in view, and row groups of about 100 rows."""
    settings = {"spark.sql.adaptive.enabled": "false", "parquet.block.size": "2048"}
    for name, value in settings.items():
        spark.conf.set(name, value)
    yield
    for name in settings:
        spark.conf.unset(name)


def scanned(df):
    """Rows that the scans of ``df`` read, and its result."""
    found = df.collect()
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    scans = [leaves.apply(i) for i in range(leaves.size())]
    return sum(s.metrics().apply("numOutputRows").value() for s in scans if "Scan" in s.nodeName()), found


def test_lookups_read_few_rows(spark, tmp_path, plain_plans):
    folder = str(tmp_path / "cells")
    features = [f"CAST(1 AS {kind}) AS {name}" for name, kind in STORED_FEATURES.items()]
    users = spark.range(50000).selectExpr("id AS user_id", *features)
    user_table.load_cells(spark, users, folder, "f")
    total = 50000 * len(STORED_FEATURES)
    assert user_table.read_table(spark, folder).count() == total
    read, found = scanned(user_table.read_table(spark, folder, key=31337))
    assert {r.row_key for r in found} == {"31337"} and len(found) == len(STORED_FEATURES)
    assert read < total / 1000
    read, found = scanned(user_table.read_head(spark, folder, 5))
    assert {r.row_key for r in found} == {"0", "1", "10", "100", "1000"}
    assert len(found) == 5 * len(STORED_FEATURES)
    assert read < total / 8
    assert user_table.read_table(spark, folder, key="no such key").count() == 0


def test_jdbc_options():
    options = user_table.jdbc_options("jdbc:db://host/x", "t", numPartitions=8)
    assert options == {
        "url": "jdbc:db://host/x", "dbtable": "t", "batchsize": "1000", "numPartitions": "8",
    }
    assert user_table.jdbc_options("u", "t", "me", "pw", batchsize=5)["batchsize"] == "5"
