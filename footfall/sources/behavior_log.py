"""Raw logs, Parquet stages and sample files."""

from footfall.schema import RAW_COLUMNS, RAW_LOG


def read_raw_log(spark, path):
    """Headerless CSV with the fixed schema.

    Permissive: a bad or missing field becomes null and extra fields are
    dropped. A landing folder partitioned by ingest time can be given as well;
    its partition columns are left out.
    """
    return spark.read.csv(path, schema=RAW_LOG, header=False).select(*RAW_COLUMNS)


def read_stage(spark, path):
    return spark.read.parquet(path)


def write_stage(df, path):
    df.write.mode("overwrite").parquet(path)


def write_sample(df, path):
    """A sample of bounded size as one CSV file with a header."""
    df.coalesce(1).write.mode("overwrite").csv(path, header=True)


def read_sample(spark, path):
    """Types are inferred, which is affordable because samples are small."""
    return spark.read.csv(path, header=True, inferSchema=True)
