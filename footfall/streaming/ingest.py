"""Landing a stream of log lines as text files in buckets of processing time."""

from pyspark.sql import functions as F
from pyspark.sql.window import Window

BUCKETS = ["ingest_date", "ingest_hour"]

# Fixed value: size at which a landed file is closed.
ROLL_BYTES = 128 * 1024 * 1024

# Lines in a slice, whose running totals are one task's work, as a power of two.
SLICE = 17


def kafka_lines(spark, servers, topic, group_id=None, max_per_trigger=None):
    """Text records of a Kafka topic, one ``value`` per record."""
    options = {"kafka.bootstrap.servers": servers, "subscribe": topic}
    if group_id:
        options["kafka.group.id"] = group_id
    if max_per_trigger:
        options["maxOffsetsPerTrigger"] = str(max_per_trigger)
    records = spark.readStream.format("kafka").options(**options).load()
    return records.select(F.col("value").cast("string").alias("value"))


def file_lines(spark, folder, max_files_per_trigger=None):
    """Lines of the text files that appear in ``folder``."""
    reader = spark.readStream
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.text(folder)


def with_buckets(lines):
    """Lines with the date and hour at which their batch is processed."""
    now = F.current_timestamp()
    return lines.select(
        "value",
        F.date_format(now, "yyyy-MM-dd").alias(BUCKETS[0]),
        F.date_format(now, "HH").alias(BUCKETS[1]),
    )


def _size():
    """The bytes of a line with its line end."""
    return (F.coalesce(F.octet_length("value"), F.lit(0)) + 1).cast("long")


def deal(lines, roll_bytes=ROLL_BYTES, tasks=None):
    """``lines`` with ``number`` and ``file``, the place of the file each ``value`` belongs to.

    Lines fill files one after the other by the bytes they take with their line end, so a file
    passes ``roll_bytes`` by less than a line. Totals come from slices of neighbouring lines,
    and one row a slice is ordered in one task. The lines must be written already: their
    numbers have to be the same whenever they are read. ``tasks`` share the slices.
    """
    numbered = lines.select(
        "*",
        F.monotonically_increasing_id().alias("number"),
        _size().alias("bytes"),
    ).withColumn("slice", F.shiftright("number", SLICE))
    slices = numbered.groupBy("slice").agg(F.sum("bytes").alias("total"))
    earlier = F.sum("total").over(Window.orderBy("slice")) - F.col("total")
    inside = F.sum("bytes").over(Window.partitionBy("slice").orderBy("number")) - F.col("bytes")
    spread = numbered.repartition(tasks, "slice") if tasks else numbered
    dealt = spread.withColumn("inside", inside).join(slices.select("slice", earlier.alias("earlier")), "slice")
    return dealt.selectExpr(*lines.columns, "number", f"(earlier + inside) DIV {int(roll_bytes)} AS file")


def in_files(lines, roll_bytes=ROLL_BYTES):
    """``deal`` with each file in a partition of its own, its lines in order.

    However many files there are, a task sorts the lines of one, or two slices on average.
    """
    total = lines.agg(F.sum(_size()).alias("bytes"), F.count("*").alias("lines")).first()
    dealt = deal(lines, roll_bytes, (total.lines >> SLICE + 1) + 1).withColumn("file", F.col("file").cast("int"))
    files = -(-(total.bytes or 1) // int(roll_bytes))
    return dealt.repartitionById(files, "file").sortWithinPartitions("file", "number")


def _land_batch(folder, roll_bytes):
    """Write a batch once, however often it is replayed.

    All lines of a batch have one bucket, which a replay finds again, as its time is kept in the
    checkpoint; it is put to the lines when they are sorted. Files are complete in a folder of the batch before the first one is moved to
    the bucket, and that folder stays until the next batch: a replay moves what is left in it.
    """

    def run(batch, number):
        spark = batch.sparkSession
        hadoop = spark._jvm.org.apache.hadoop.fs.Path
        work = hadoop(f"{folder}/_landing")
        files = work.getFileSystem(spark._jsc.hadoopConfiguration())
        own = hadoop(work, f"batch-{number}")
        if not files.exists(hadoop(own, "_SUCCESS")):
            files.delete(work, True)  # earlier batches, which are done
            batch.write.parquet(f"{work.toString()}/lines-{number}")
            lines = spark.read.schema(batch.schema).parquet(f"{work.toString()}/lines-{number}")
            bucket = lines.select(*BUCKETS).first() or [""] * len(BUCKETS)
            (
                in_files(lines.select("value"), roll_bytes)
                .select("value", *[F.lit(v).alias(c) for c, v in zip(BUCKETS, bucket, strict=True)], "file")
                .write.partitionBy(*BUCKETS, "file")
                .text(own.toString())
            )
        for status in files.globStatus(hadoop(own, f"{'=*/'.join(BUCKETS)}=*/file=*/part-*")):
            path = status.getPath()
            place = path.getParent()
            hour = place.getParent()
            goal = hadoop(hadoop(folder, hour.getParent().getName()), hour.getName())
            files.mkdirs(goal)
            name = f"part-{number:08d}-{int(place.getName().split('=')[1]):06d}.txt"
            if not files.rename(path, hadoop(goal, name)):
                raise RuntimeError(f"{path.toString()} could not be moved to {goal.toString()}")

    return run


def land(lines, folder, checkpoint, trigger=None, roll_bytes=ROLL_BYTES):
    """Start landing ``lines`` under ``folder/ingest_date=/ingest_hour=``.

    Every line lands exactly once, across restarts too. Each trigger (60 seconds unless told
    otherwise) writes files of ``roll_bytes`` and one with the rest. The folder must be new, or
    have been filled by this function.
    """
    return (
        with_buckets(lines)
        .writeStream.foreachBatch(_land_batch(folder, roll_bytes))
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "60 seconds"}))
        .start()
    )


def as_lines(raw):
    """Raw log rows as the text lines a producer would send; nulls are empty."""
    fields = ", ".join(f"coalesce(string(`{c}`), '')" for c in raw.columns)
    return raw.selectExpr(f"concat_ws(',', {fields}) AS value")
