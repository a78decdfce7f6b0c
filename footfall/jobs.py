"""Command-line jobs: ``spark-submit footfall/jobs.py <job> [options]``.

Each job is a function ``(spark, options)``; options fall back to environment
variables of the same meaning. Errors are raised, never printed and dropped.
"""

import argparse
import os
import time

from footfall.operators.cells import cell_row_count, decode_numbers
from footfall.operators.clean import behavior_counts, clean_events, validation_counts
from footfall.operators.distributions import equal_width_histogram
from footfall.operators.event_features import event_features
from footfall.operators.user_features import (
    stored_rows,
    user_features,
    users_of_event_features,
)
from footfall.plans import feature_query, figures, profile, summary
from footfall.schema import STORED_FEATURES
from footfall.session import fit_shuffles, session
from footfall.sources import behavior_log, user_table
from footfall.streaming import ingest

# Rows a query shows unless told otherwise, and the most it ever shows.
TOP_N = 10
SHOWN = 1000


def clean(spark, options):
    """Raw log to cleaned log; counts are taken from what was written."""
    fit_shuffles(spark, options.input)
    raw = behavior_log.read_raw_log(spark, options.input)
    behavior_log.write_stage(clean_events(raw), options.output)
    cleaned = behavior_log.read_stage(spark, options.output)
    validation_counts(cleaned).show()
    behavior_counts(cleaned).show()


def features(spark, options):
    """Cleaned log to event features and, if asked for, user features."""
    started = time.time()
    fit_shuffles(spark, options.input)
    events = behavior_log.read_stage(spark, options.input)
    behavior_log.write_stage(event_features(events, options.as_of), options.output)
    if options.user_output:
        behavior_log.write_stage(user_features(events, options.as_of), options.user_output)
    print(f"minutes: {(time.time() - started) / 60:.2f}")


def profile_features(spark, options):
    """Description, schema, quartiles and histogram of the whole table, and a sample."""
    fit_shuffles(spark, options.input)
    table = behavior_log.read_stage(spark, options.input)
    behavior_log.write_stage(profile.describe(table), f"{options.output}/description")
    behavior_log.write_stage(profile.schema_rows(table), f"{options.output}/schema")
    behavior_log.write_stage(profile.quartiles(table), f"{options.output}/quartiles")
    behavior_log.write_stage(
        equal_width_histogram(table, "buy_ratio", 50), f"{options.output}/buy_ratio"
    )
    behavior_log.write_sample(
        profile.sample(table, options.sample_limit), f"{options.output}/sample"
    )
    profile.sample(table, 10).show()


def load(spark, options):
    """Load user features into the user table or the cell table, then check it.

    The input may be event features (reduced to a row per user) or user features.
    """
    fit_shuffles(spark, options.input)
    source = behavior_log.read_stage(spark, options.input)
    rows = stored_rows(users_of_event_features(source.select("user_id", *STORED_FEATURES)))
    if options.db == "cells":
        user_table.load_cells(spark, rows, options.table, options.family)
        cell_row_count(user_table.read_table(spark, options.table)).show()
        user_table.read_head(spark, options.table, options.verify_limit).show(truncate=False)
        return
    # Users only the relational table knows stay in it: it is merged, then replaced.
    stored = user_table.read_jdbc(spark, _jdbc(options)) if options.jdbc_url else None
    user_table.load_users(spark, rows, options.table, stored=stored)
    users = user_table.read_table(spark, options.table)
    if options.jdbc_url:
        user_table.write_jdbc(users, _jdbc(options))
    feature_query.verify_table(users, options.verify_limit).show(truncate=False)


def _jdbc(options):
    return user_table.jdbc_options(
        options.jdbc_url,
        options.jdbc_table,
        os.environ.get("JDBC_USER"),
        os.environ.get("JDBC_PASSWORD"),
        **(
            {
                "partitionColumn": "user_id",
                "lowerBound": options.jdbc_lower,
                "upperBound": options.jdbc_upper,
                "numPartitions": options.jdbc_partitions,
            }
            if options.jdbc_partitions
            else {}
        ),
    )


def _users(spark, options, columns=None, key=None):
    if options.jdbc_url:
        return user_table.read_jdbc(spark, _jdbc(options), columns)
    if key is None:
        fit_shuffles(spark, *user_table.table_paths(spark, options.table))
    return user_table.read_table(spark, options.table, columns, key)


def query(spark, options):
    """Filtered, sorted and paged user features."""
    wanted = {
        name: getattr(options, name)
        for name in (
            "user_id", "top_n", "min_active_days", "max_active_days", "min_buy_ratio",
            "max_buy_ratio", "order_by", "desc", "limit", "offset",
        )
    }
    if wanted["top_n"] is None and not options.output:
        wanted["top_n"] = TOP_N
    wanted["fields"] = [f.strip() for f in options.fields.split(",")] if options.fields else None
    ask = feature_query.query_cells if options.db == "cells" else feature_query.query_table
    found = ask(_users(spark, options, key=options.user_id), **wanted)
    if options.output:
        behavior_log.write_stage(found, options.output)
    else:
        found.show(min(options.limit or wanted["top_n"] or SHOWN, SHOWN), truncate=False)


def summarise(spark, options):
    """Overview figures and segments."""
    users = _users(spark, options)
    summary.activity_summary(users).show()
    summary.purchase_summary(users).show()
    summary.user_segments(users).show()


def figure_data(spark, options):
    """One table per figure."""
    columns = ["user_id", *figures.PAIR_COLUMNS]
    if options.db == "cells":
        users = decode_numbers(_users(spark, options), columns)
    else:
        users = _users(spark, options, columns)
    # Every figure reads this stage, whatever the table is stored as.
    behavior_log.write_stage(users, f"{options.output}/users")
    users = behavior_log.read_stage(spark, f"{options.output}/users")
    for name, table in figures.figure_tables(users, options.top_n).items():
        behavior_log.write_stage(table, f"{options.output}/{name}")


def land(spark, options):
    """Land a Kafka topic until the job is stopped."""
    lines = ingest.kafka_lines(
        spark, options.servers, options.topic, options.group_id, options.max_per_trigger
    )
    ingest.land(
        lines, options.output, options.checkpoint, roll_bytes=options.roll_bytes
    ).awaitTermination()


def _path(parser, name, variable, required=True):
    default = os.environ.get(variable)
    parser.add_argument(name, default=default, required=required and default is None)


def _store(parser):
    parser.add_argument("--db", choices=["table", "cells"], default="table")
    _path(parser, "--table", "USER_TABLE", required=False)
    parser.add_argument("--jdbc-url", default=os.environ.get("JDBC_URL"))
    parser.add_argument("--jdbc-table", default="user_features")
    parser.add_argument("--jdbc-partitions", type=int, help="connections to read with")
    parser.add_argument("--jdbc-lower", type=int, default=0, help="about the least user id")
    parser.add_argument("--jdbc-upper", type=int, default=1 << 31, help="about the greatest")


def parse(arguments=None):
    parser = argparse.ArgumentParser(prog="footfall")
    parser.add_argument("--zone", default="UTC", help="session time zone")
    jobs = parser.add_subparsers(dest="job", required=True)

    def add(name, job):
        sub = jobs.add_parser(name, help=job.__doc__.splitlines()[0])
        sub.set_defaults(run=job)
        return sub

    sub = add("clean", clean)
    _path(sub, "--input", "HDFS_RAW_INPUT")
    _path(sub, "--output", "HDFS_CLEANED_OUTPUT")

    sub = add("features", features)
    _path(sub, "--input", "HDFS_CLEANED_INPUT")
    _path(sub, "--output", "HDFS_FEATURE_OUTPUT")
    sub.add_argument("--user-output")
    sub.add_argument("--as-of", help="yyyy-MM-dd, today unless given")

    sub = add("profile", profile_features)
    _path(sub, "--input", "HDFS_FEATURE_INPUT")
    _path(sub, "--output", "PROFILE_OUTPUT")
    sub.add_argument("--sample-limit", type=int, default=1000)

    sub = add("load", load)
    _path(sub, "--input", "HDFS_FEATURE_INPUT")
    _store(sub)
    sub.add_argument("--family", default=os.environ.get("HBASE_COLUMN_FAMILY", "f"))
    sub.add_argument("--verify-limit", type=int, default=5)

    sub = add("query", query)
    _store(sub)
    sub.add_argument("--user-id", "--user_id")
    sub.add_argument("--top-n", "--topn", type=int, help="10, or all rows with --output")
    for bound in ("min", "max"):
        sub.add_argument(f"--{bound}-active-days", f"--{bound}_active_days", type=float)
        sub.add_argument(f"--{bound}-buy-ratio", f"--{bound}_buy_ratio", type=float)
    sub.add_argument("--order-by", "--order_by")
    sub.add_argument("--desc", action="store_true")
    sub.add_argument("--fields", help="comma-separated")
    sub.add_argument("--limit", type=int)
    sub.add_argument("--offset", type=int)
    sub.add_argument("--output", help="write here instead of showing")

    _store(add("summary", summarise))

    sub = add("figures", figure_data)
    _store(sub)
    _path(sub, "--output", "FIGURE_OUTPUT")
    sub.add_argument("--top-n", "--topn", type=int, default=10)

    sub = add("land", land)
    _path(sub, "--servers", "KAFKA_SERVERS")
    _path(sub, "--topic", "KAFKA_TOPIC")
    _path(sub, "--output", "LANDING_OUTPUT")
    _path(sub, "--checkpoint", "LANDING_CHECKPOINT")
    sub.add_argument("--group-id")
    sub.add_argument("--max-per-trigger", type=int)
    sub.add_argument("--roll-bytes", type=int, default=ingest.ROLL_BYTES)
    return parser.parse_args(arguments)


def main(arguments=None):
    options = parse(arguments)
    spark = session(f"footfall-{options.job}", options.zone)
    try:
        options.run(spark, options)
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
