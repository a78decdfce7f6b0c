"""Profile of a feature table: schema, description, quartiles and a sample."""

from pyspark.sql import functions as F
from pyspark.sql.types import NumericType, StringType

from footfall.operators.distributions import quartile_counts, quartiles_of, running_totals
from footfall.schema import EVENT_ORDER


def _numeric(df):
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType)]


def _texts(df):
    return [f.name for f in df.schema.fields if isinstance(f.dataType, StringType)]


def _one_row_each(df, structs):
    """One row per struct of aggregates, from a single pass over ``df``."""
    return df.selectExpr(f"array({', '.join(structs)}) AS entries").selectExpr("inline(entries)")


def describe(df):
    """Count, mean, deviation and extremes of numeric and text columns.

    Extremes of text columns are in their own two columns, so numbers stay
    numbers. Other types are left out.

    Numeric columns are stacked into (column, value) rows and combined on the map
    side, which keeps the generated code small however many columns there are.
    Extremes of text cannot be hash-aggregated by group, so the few text columns
    are aggregated side by side.
    """
    pairs = ", ".join(f"struct('{c}' AS column_name, double(`{c}`) AS value)" for c in _numeric(df))
    numbers = (
        df.selectExpr(f"inline(array({pairs}))")
        .groupBy("column_name")
        .agg(
            F.expr("count(value) AS count"),
            F.expr("avg(value) AS mean"),
            F.expr("stddev_samp(value) AS stddev"),
            F.expr("min(value) AS min"),
            F.expr("max(value) AS max"),
        )
        .selectExpr("*", "string(NULL) AS min_text", "string(NULL) AS max_text")
    )
    texts = [
        f"""struct('{c}' AS column_name, count(`{c}`) AS count, double(NULL) AS mean,
                   double(NULL) AS stddev, double(NULL) AS min, double(NULL) AS max,
                   min(`{c}`) AS min_text, max(`{c}`) AS max_text)"""
        for c in _texts(df)
    ]
    return numbers.unionByName(_one_row_each(df, texts)) if texts else numbers


def schema_rows(df):
    """Position, name and type of each column with its number of values."""
    return _one_row_each(
        df,
        [
            f"""struct({position} AS position, '{field.name}' AS column_name,
                       '{field.dataType.simpleString()}' AS data_type,
                       count(`{field.name}`) AS values)"""
            for position, field in enumerate(df.schema.fields, 1)
        ],
    )


def sample(features, n=1000):
    """The first ``n`` events by user and time: small, and the same every time."""
    order = [c for c in ("user_id", *EVENT_ORDER) if c in features.columns]
    return features.orderBy(*order).limit(n)


def quartiles(df):
    """Count, mean, deviation, extremes and interpolated quartiles per numeric column.

    Quartiles come from the counts of the values next to them and their running totals,
    so no task holds a column and hardly any values are shuffled.
    """
    columns = _numeric(df)
    pairs = ", ".join(f"struct('{c}' AS series, double(`{c}`) AS value)" for c in columns)
    counts, brackets = quartile_counts(df.selectExpr(f"inline(array({pairs}))").filter("value IS NOT NULL"))
    plain = describe(df.select(*columns)).selectExpr(
        "column_name", "count", "mean", "stddev AS std", "min", "max"
    )
    found = quartiles_of(running_totals(counts), brackets).selectExpr(
        "series AS column_name", "q1 AS p25", "median AS p50", "q3 AS p75"
    )
    return plain.join(found, "column_name", "left").select(
        "column_name", "count", "mean", "std", "min", "p25", "p50", "p75", "max"
    )
