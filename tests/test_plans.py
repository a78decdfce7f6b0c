"""Plan shapes that matter at scale."""

import re

from footfall.operators.event_features import event_features, trailing_features
from footfall.operators.user_features import user_features
from footfall.plans.feature_query import query_table
from footfall.sources.behavior_log import write_stage


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_trailing_features_shuffle_events_once(spark, cleaned, tmp_path):
    path = str(tmp_path / "cleaned")
    write_stage(cleaned, path)
    text = plan(trailing_features(spark.read.parquet(path)))
    main = text[: text.index("BroadcastExchange")]
    assert main.count("Exchange hashpartitioning(user_id") == 1
    assert len(re.findall(r"\bWindow \[", main)) == 1


def test_user_features_use_no_window(cleaned):
    assert "Window" not in plan(user_features(cleaned, "2024-01-09"))


def test_item_counts_are_computed_only_when_asked_for(cleaned):
    users = user_features(cleaned, "2024-01-09")
    assert "Join" in plan(users)
    assert "Join" not in plan(users.select("user_id", "active_days", "buy_ratio"))


def test_user_features_do_not_multiply_events(cleaned):
    assert "Expand" not in plan(user_features(cleaned, "2024-01-09"))


def test_no_cross_joins_anywhere(spark, small):
    from registry.queries import QUERIES

    for name, query in QUERIES.items():
        if name != "ingest_buckets":
            text = plan(query(spark, small))
            assert "CartesianProduct" not in text and "NestedLoopJoin" not in text, name


def test_event_features_do_not_shuffle_events_for_the_join(spark, cleaned, tmp_path):
    path = str(tmp_path / "cleaned")
    write_stage(cleaned, path)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(event_features(spark.read.parquet(path), "2024-01-09"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    join = text[text.index("SortMergeJoin") :]
    left = join[: join.index("Window [")]
    assert "Exchange hashpartitioning" not in left.split("BroadcastExchange")[0]


def test_lookup_reaches_the_scan(spark, cleaned, tmp_path):
    from footfall.operators.user_features import stored_rows

    path = str(tmp_path / "users")
    write_stage(stored_rows(user_features(cleaned, "2024-01-09")), path)
    found = query_table(
        spark.read.parquet(path), user_id="1", min_active_days=1, fields=["buy_ratio"]
    )
    text = plan(found)
    assert "EqualTo(user_id,1)" in text
    schema = re.search(r"ReadSchema: struct<([^>]*)>", text).group(1)
    assert schema == "user_id:bigint,active_days:int,buy_ratio:double"


def test_shuffle_partitions_follow_input_size(spark, tmp_path, monkeypatch):
    from footfall import session

    (tmp_path / "log.csv").write_text("1,2,3,pv,4\n" * 1000)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        session.fit_shuffles(spark, str(tmp_path))
        assert spark.conf.get("spark.sql.shuffle.partitions") == before
        monkeypatch.setattr(session, "SHUFFLE_BYTES", 1000)
        session.fit_shuffles(spark, str(tmp_path / "*.csv"))
        assert spark.conf.get("spark.sql.shuffle.partitions") == "11"
        session.fit_shuffles(spark, str(tmp_path / "none"))
        assert spark.conf.get("spark.sql.shuffle.partitions") == "11"
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
