import re

import pytest

from footfall import jobs
from footfall.plans.figures import figure_tables
from footfall.schema import STORED_FEATURES
from footfall.sources.behavior_log import read_raw_log, read_stage
from footfall.sources.user_table import current_version, load_cells, load_users, read_table
from footfall.streaming import ingest
from tests.conftest import H1, rows

NOW = {"availableNow": True}


def csv_lines(lines):
    return "".join(",".join("" if v is None else str(v) for v in l) + "\n" for l in lines)


def test_each_line_lands_once_across_a_restart(spark, tmp_path):
    source, landed = tmp_path / "source", tmp_path / "landed"
    source.mkdir()
    for number in (1, 2):
        (source / f"{number}.log").write_text("".join(f"{number}-{i}\n" for i in range(50)))
        query = ingest.land(
            ingest.file_lines(spark, str(source), 1),
            str(landed),
            str(tmp_path / "checkpoint"),
            trigger=NOW,
            roll_bytes=100,
        )
        query.awaitTermination()
    got = sorted(r.value for r in spark.read.text(str(landed)).collect())
    assert got == sorted(f"{n}-{i}" for n in (1, 2) for i in range(50))
    folders = {str(p.parent.relative_to(landed)) for p in landed.rglob("part-*.txt")}
    assert all(
        re.fullmatch(r"ingest_date=\d{4}-\d\d-\d\d/ingest_hour=\d\d", f) for f in folders
    )
    assert max(p.stat().st_size for p in landed.rglob("part-*.txt")) <= 104


def test_files_are_rolled_by_bytes(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(ingest, "SLICE", 6)
    source = tmp_path / "source"
    source.mkdir()
    lines = [("é" if i % 3 else "x") * (10 if i % 2 else 2500) + str(i) for i in range(800)]
    (source / "a.log").write_text("\n".join(lines))
    ingest.land(
        ingest.file_lines(spark, str(source)), str(tmp_path / "l"), str(tmp_path / "c"), NOW, roll_bytes=100_000
    ).awaitTermination()
    files = sorted((tmp_path / "l").glob("ingest_date=*/ingest_hour=*/part-*.txt"))
    assert all(90_000 <= p.stat().st_size <= 110_000 for p in files[:-1]) and len(files) > 10
    assert [l for p in files for l in p.read_text().splitlines()] == lines


def test_a_task_sorts_the_lines_of_one_file(spark, tmp_path):
    lines = [f"{i:05d}" + "x" * (i % 30) for i in range(3000)]
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.parquet(str(tmp_path / "lines"))
    given = spark.read.parquet(str(tmp_path / "lines"))
    for roll_bytes in (500, 10**9):
        found = ingest.in_files(given, roll_bytes).selectExpr("spark_partition_id() AS task", "file", "value").collect()
        by_task = {}
        for r in found:
            by_task.setdefault(r.task, set()).add(r.file)
        assert all(len(files) == 1 for files in by_task.values())
        assert len(by_task) == len({r.file for r in found}) == found[-1].file + 1
        assert [r.value for r in found] == lines
    assert ingest.in_files(given.limit(0)).collect() == []


def test_a_replayed_batch_lands_once(spark, tmp_path):
    lines = [f"line {i}" for i in range(300)]
    batch = spark.createDataFrame([(l,) for l in lines], "value string").selectExpr(
        "value", "'2024-01-02' AS ingest_date", "'03' AS ingest_hour"
    )
    run = ingest._land_batch(str(tmp_path), 500)
    landed = lambda: sorted(r.value for r in spark.read.text(str(tmp_path)).select("value").collect())
    run(batch, 0)
    run(batch, 0)
    assert landed() == sorted(lines)
    # A batch that died while its files were moved.
    some = sorted(tmp_path.glob("ingest_date=2024-01-02/ingest_hour=03/part-*.txt"))
    assert len(some) > 3
    back = next((tmp_path / "_landing").glob("batch-0/*/*/file=0"))
    some[0].rename(back / "part-again.txt")
    run(batch, 0)
    assert landed() == sorted(lines)
    run(batch, 1)
    assert landed() == sorted(lines * 2)
    assert [p.name for p in (tmp_path / "_landing").glob("batch-*")] == ["batch-1"]
    run(batch.limit(0), 2)
    assert landed() == sorted(lines * 2)


def test_landed_lines_are_a_raw_log(spark, raw, tmp_path):
    source = tmp_path / "source"
    source.mkdir()
    (source / "a.log").write_text("\n".join(r.value for r in ingest.as_lines(raw).collect()))
    ingest.land(
        ingest.file_lines(spark, str(source)), str(tmp_path / "l"), str(tmp_path / "c"), NOW
    ).awaitTermination()
    assert sorted(rows(read_raw_log(spark, str(tmp_path / "l"))), key=str) == sorted(H1, key=str)


def test_kafka_source_is_configured(spark, monkeypatch):
    seen = {}

    class Reader:
        def format(self, name):
            seen["format"] = name
            return self

        def options(self, **options):
            seen.update(options)
            return self

        def load(self):
            return spark.createDataFrame([(b"1,2,3,pv,4",)], "value binary")

    class Session:
        readStream = Reader()

    lines = ingest.kafka_lines(Session(), "host:9092", "topic", "group", 500)
    assert rows(lines) == [("1,2,3,pv,4",)]
    assert seen == {
        "format": "kafka", "kafka.bootstrap.servers": "host:9092", "subscribe": "topic",
        "kafka.group.id": "group", "maxOffsetsPerTrigger": "500",
    }


def test_jobs_from_raw_log_to_figures(spark, tmp_path, capsys):
    (tmp_path / "log.csv").write_text(csv_lines(H1))
    at = lambda name: str(tmp_path / name)

    def run(*arguments):
        options = jobs.parse(list(arguments))
        options.run(spark, options)
        return capsys.readouterr().out

    out = run("clean", "--input", at("log.csv"), "--output", at("cleaned"))
    assert "total_records" in out
    run(
        "features", "--input", at("cleaned"), "--output", at("features"),
        "--user-output", at("users"), "--as-of", "2024-01-09",
    )
    assert read_stage(spark, at("features")).count() == 6
    assert read_stage(spark, at("users")).count() == 3

    run("profile", "--input", at("features"), "--output", at("profile"), "--sample-limit", "4")
    assert read_stage(spark, at("profile/description")).count() > 20
    assert read_stage(spark, at("profile/buy_ratio")).selectExpr("sum(count)").first()[0] == 6
    assert read_stage(spark, at("profile/quartiles")).filter("p50 IS NOT NULL").count() > 10

    for source in ("features", "users"):
        run("load", "--input", at(source), "--table", at("table"))
    assert current_version(spark, at("table")).endswith("000002")
    assert read_table(spark, at("table")).count() == 3
    out = run("load", "--input", at("features"), "--db", "cells", "--table", at("cells"))
    assert "f:active_days" in out

    out = run("query", "--table", at("table"), "--order-by", "buy_ratio", "--desc", "--top-n", "1")
    assert re.search(r"\|3 +\|1 ", out)
    out = run(
        "query", "--db", "cells", "--table", at("cells"), "--user_id", "2", "--fields", "pv_ratio"
    )
    assert re.search(r"\|2 +\|1\.0", out)
    run("query", "--table", at("table"), "--max-active-days", "1", "--output", at("found"))
    assert read_stage(spark, at("found")).count() == 2
    assert "单日用户" in run("summary", "--table", at("table"))

    for db, table in (("table", "table"), ("cells", "cells")):
        run("figures", "--db", db, "--table", at(table), "--output", at(f"figures_{db}"))
        for name in figure_tables(read_table(spark, at("table"))):
            read_stage(spark, at(f"figures_{db}/{name}"))


def test_query_output_is_complete(spark, tmp_path):
    stored = spark.range(40).selectExpr("id AS user_id", *[f"1 AS {c}" for c in STORED_FEATURES])
    load_users(spark, stored, str(tmp_path / "t"), "2024-01-01 00:00:00")
    load_cells(spark, stored, str(tmp_path / "c"), "f")
    for db, name in (("table", "t"), ("cells", "c")):
        found = str(tmp_path / f"found_{db}")
        given = ["query", "--db", db, "--table", str(tmp_path / name), "--output", found]
        options = jobs.parse(given)
        options.run(spark, options)
        assert read_stage(spark, found).count() == 40


def test_jdbc_reads_in_parts():
    options = jobs.parse(
        ["load", "--input", "i", "--jdbc-url", "u", "--jdbc-partitions", "8", "--jdbc-upper", "99"]
    )
    given = jobs._jdbc(options)
    assert given["partitionColumn"] == "user_id"
    assert (given["lowerBound"], given["upperBound"], given["numPartitions"]) == ("0", "99", "8")


def test_relational_rows_are_merged(spark, tmp_path, monkeypatch):
    """No database runs here: reading and writing it are replaced."""
    row = lambda ids: spark.createDataFrame([(i,) for i in ids], "user_id long").selectExpr(
        "user_id", *[f"cast({1} AS {t}) AS {c}" for c, t in STORED_FEATURES.items()]
    )
    held = row([1, 2]).selectExpr("*", "timestamp '2020-01-01' AS created_at")
    written = []
    monkeypatch.setattr(jobs.user_table, "read_jdbc", lambda *a: held)
    monkeypatch.setattr(jobs.user_table, "write_jdbc", lambda users, o: written.append(users))
    row([2, 3]).write.parquet(str(tmp_path / "batch"))
    options = jobs.parse(
        ["load", "--input", str(tmp_path / "batch"), "--table", str(tmp_path / "t"), "--jdbc-url", "u"]
    )
    options.run(spark, options)
    got = {r.user_id: r.created_at.year for r in written[0].collect()}
    assert got.keys() == {1, 2, 3} and got[1] == got[2] == 2020 and got[3] > 2020


def test_missing_paths_are_refused(monkeypatch):
    monkeypatch.delenv("HDFS_RAW_INPUT", raising=False)
    with pytest.raises(SystemExit):
        jobs.parse(["clean", "--output", "x"])
    monkeypatch.setenv("HDFS_RAW_INPUT", "somewhere")
    assert jobs.parse(["clean", "--output", "x"]).input == "somewhere"


def test_errors_are_raised(spark, tmp_path):
    options = jobs.parse(["clean", "--input", str(tmp_path / "none"), "--output", "x"])
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        options.run(spark, options)
