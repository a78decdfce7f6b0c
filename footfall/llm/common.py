"""What the operators share: tables, checkpoints, row identities, shuffle-safe settings."""

from pyspark.sql import functions as F

from ..session import shared_folder

# Words are runs of anything but these six characters.
SPACES = "[\\x20\\x09-\\x0D]+"


def table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def checkpoint(df):
    """Materialise ``df`` in the folder all executors share and cut its lineage.

    The cluster names the folder in ``spark.checkpoint.dir``; where that is unset, as in
    tests, it lies in the warehouse.
    """
    spark = df.sparkSession
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(spark))
    return df.checkpoint()


def whole_text(name="text"):
    """The text, empty where it is null."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def remainder(column, modulus):
    """crc32 of the value as text, modulo ``modulus``."""
    return F.pmod(F.crc32(column.cast("string").cast("binary")), F.lit(modulus))


def keep(df, condition):
    """Rows where a measured condition holds, decided after the measuring.

    A plain filter would be moved below the projections that build its columns, and would
    then compute them again for every use of them.
    """
    marked = df.withColumn("_after", F.monotonically_increasing_id())
    return marked.where(condition & (F.col("_after") >= 0)).drop("_after")


HOT_KEYS = 10_000


def join_counted(rows, keyed, key, n, total):
    """Inner join of ``rows`` with ``keyed``, which has a row per key and its number ``n`` of rows.

    Keys that hold more than a ``HOT_KEYS``-th of all ``total`` rows are fewer than
    ``HOT_KEYS``, so they are broadcast and their rows stay where they are.
    """
    hot = F.col(n) * HOT_KEYS > total
    often = F.broadcast(keyed.where(hot))
    rest = rows.join(F.broadcast(keyed.where(hot).select(key)), key, "left_anti")
    return rows.join(often, key).unionByName(rest.join(keyed.where(~hot), key)).drop(n)


def let(value, body):
    """Evaluate ``value`` once and use it many times inside ``body``."""
    return F.transform(F.array(value), body)[0]


def small_batches(spark):
    """Bound the Arrow batches a Python worker holds: by size, which long texts need."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "20000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(8 << 20))
