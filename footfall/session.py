"""Session set-up and the shared scratch folder."""

from pyspark.sql import SparkSession


def session(name="footfall", zone="UTC", **conf):
    """A session whose calendar arithmetic does not depend on the host."""
    builder = SparkSession.builder.appName(name).config("spark.sql.session.timeZone", zone)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


# Input bytes per shuffle partition.
SHUFFLE_BYTES = 256 * 1024 * 1024


def fit_shuffles(spark, *paths):
    """Give the session enough shuffle partitions for the files under ``paths``.

    Adaptive execution merges partitions that turn out small but never adds any,
    so the number has to suit the input from the start. A larger setting stays.
    """
    size = 0
    for path in paths:
        files = spark._jvm.org.apache.hadoop.fs.Path(path)
        system = files.getFileSystem(spark._jsc.hadoopConfiguration())
        size += sum(
            system.getContentSummary(status.getPath()).getLength()
            for status in system.globStatus(files) or []
        )
    current = int(spark.conf.get("spark.sql.shuffle.partitions"))
    wanted = -(-size // SHUFFLE_BYTES)
    spark.conf.set("spark.sql.shuffle.partitions", max(current, wanted))


def shared_folder(spark):
    """The folder all executors share: ``spark.checkpoint.dir``, else one in the warehouse."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    return (shared or f"{spark.conf.get('spark.sql.warehouse.dir')}/_scratch").rstrip("/")


def scratch_dir(spark, prefix):
    """A new folder every executor can see."""
    unique = spark._jvm.java.util.UUID.randomUUID().toString()
    return f"{shared_folder(spark)}/{prefix}-{unique}"


def checkpoint(df):
    """Materialise ``df`` in the folder all executors share and cut its lineage."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint()
