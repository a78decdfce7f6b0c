"""Stored user features: versioned Parquet snapshots, or a JDBC table.

Rows lie in ``PARTS`` parts by a hash of their key, partitions of the Parquet table. A version
holds the parts its load has touched, read and written by that load alone; the table is each
part in its latest version. The first version, and every ``WHOLE_EVERY``-th one at the
latest, is whole: nothing before it counts.

A load never overwrites what it reads. It writes to a folder of its own, claims the
place after the version it was merged with, and renames the folder to the next version.
Readers see the table before or after a load and nothing in between; of two loads that
started from one version, the second to finish fails and has to be run again. A claim
names the folder, which is complete by then, so that the next load finishes the rename of
one that died in between.
"""

from pyspark.sql import functions as F

from footfall.operators.cells import encode_cells, head_cells, merge_cells
from footfall.operators.upsert import upsert_users
from footfall.session import checkpoint

VERSION = "version={:06d}"
# The layout of stored tables: one with another number of parts has to be loaded anew.
PARTS = 256
# Versions listed by a reader, at most.
WHOLE_EVERY = 64
# In a whole version: an empty table with the columns of the rows.
WHOLE = "_whole"


def _files(spark, folder):
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def _versions(spark, folder):
    """Version numbers in ``folder``: all of them, and the committed ones."""
    files, path = _files(spark, folder)
    if not files.exists(path):
        return [], []
    found, committed = [], []
    for status in files.listStatus(path):
        name = status.getPath().getName()
        if name.startswith("version="):
            number = int(name.split("=")[1])
            found.append(number)
            if files.exists(spark._jvm.org.apache.hadoop.fs.Path(status.getPath(), "_SUCCESS")):
                committed.append(number)
    return found, committed


def current_version(spark, folder):
    """Path of the latest committed version, or None."""
    _, committed = _versions(spark, folder)
    return f"{folder}/{VERSION.format(max(committed))}" if committed else None


def _part(key):
    return F.pmod(F.xxhash64(key), F.lit(PARTS)).cast("int")


def _parts(spark, folder):
    """The whole version that counts, how many follow it, and the folder of each part."""
    files, _ = _files(spark, folder)
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    _, committed = _versions(spark, folder)
    found = {}
    for after, number in enumerate(sorted(committed, reverse=True)):
        path = f"{folder}/{VERSION.format(number)}"
        for status in files.listStatus(hadoop(path)):
            name = status.getPath().getName()
            if name.startswith("part="):
                found.setdefault(name, f"{path}/{name}")
        if files.exists(hadoop(path, WHOLE)):
            return path, after, found
    raise FileNotFoundError(f"no committed version in {folder}")


def table_paths(spark, folder):
    """The folders that hold the table's rows."""
    return list(_parts(spark, folder)[2].values())


def _read(spark, folder):
    """The rows, with the number of their part in ``part``."""
    whole, _, found = _parts(spark, folder)
    none = spark.read.parquet(f"{whole}/{WHOLE}")
    if not found:
        return none.withColumn("part", F.lit(0))
    rows = spark.read.schema(none.schema).option("basePath", folder).parquet(*found.values())
    return rows.drop("version")


def read_table(spark, folder, columns=None, key=None):
    """The table's rows, all of them or those with ``key``, read from its part alone."""
    table = _read(spark, folder)
    if key is not None:
        name = table.columns[0]
        wanted = F.lit(key).try_cast(table.schema[name].dataType)
        table = table.where((F.col("part") == _part(wanted)) & (F.col(name) == wanted))
    table = table.drop("part")
    return table.select(*columns) if columns else table


def read_head(spark, folder, n=5):
    """All cells of the first ``n`` row keys of a cell table.

    The n-th key of one part is at or after the n-th of the table. So of every other part
    only the row groups that start at or before it are read, the first ones as a rule.
    """
    cells = _read(spark, folder)
    found = table_paths(spark, folder)
    if found:
        part = int(found[0].rsplit("=", 1)[1])
        keys = cells.where((F.col("part") == part) & F.col("row_key").isNotNull())
        last = keys.select("row_key").distinct().orderBy("row_key").limit(n).collect()
        if len(last) == n and n:
            cells = cells.where(F.col("row_key") <= last[-1].row_key)
    return head_cells(cells.drop("part"), n)


def _claim(base):
    return f"_claims/{base.rstrip('/').rsplit('/', 1)[1] if base else 'first'}"


def _place(spark, folder, own):
    """Rename a load's folder to the version after the last one."""
    files, _ = _files(spark, folder)
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    found, _ = _versions(spark, folder)
    path = f"{folder}/{VERSION.format(max(found, default=0) + 1)}"
    if files.exists(hadoop(own)) and files.rename(hadoop(own), hadoop(path)):
        return path
    if files.exists(hadoop(own)):
        raise RuntimeError(f"{own} could not be renamed to {path}")
    return current_version(spark, folder)  # another load has finished this one


def _finish(spark, folder):
    """Place the load that has claimed the current version but was not renamed, if there is one.

    A load's files are complete before its claim, and the claim names their folder.
    """
    base = current_version(spark, folder)
    files, _ = _files(spark, folder)
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    claims = hadoop(f"{folder}/{_claim(base)}.by")
    if not files.exists(claims):
        return
    for status in files.listStatus(claims):
        own = hadoop(f"{folder}/{status.getPath().getName()}")
        if files.exists(own):
            _place(spark, folder, own.toString())


def _publish(spark, df, folder, key, base, whole=False):
    """Write the version after ``base``. Files hold ranges of keys, so that lookups read
    only the row groups whose range holds the key."""
    files, _ = _files(spark, folder)
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    unique = spark._jvm.java.util.UUID.randomUUID().toString()
    own = f"{folder}/_load-{unique}"
    parted = df.withColumn("part", _part(key)).repartitionByRange("part", key)
    parted.sortWithinPartitions("part", key).write.partitionBy("part").parquet(own)
    if whole:
        spark.createDataFrame([], df.schema).write.parquet(f"{own}/{WHOLE}")
    # A folder is renamed into its claim's place only if nothing is there: one load for each
    # base. It holds one file, with the name of the load.
    mine = hadoop(f"{folder}/_claims/_{unique}")
    files.createNewFile(hadoop(mine, f"_load-{unique}"))
    claim = hadoop(f"{folder}/{_claim(base)}.by")
    if files.exists(claim) or not files.rename(mine, claim) or not files.exists(hadoop(claim, f"_load-{unique}")):
        raise RuntimeError(f"another load has replaced {base or 'the empty table'}; run it again")
    return _place(spark, folder, own)


def _load(spark, batch, folder, key, merge, stored=None):
    """Publish ``batch`` merged with the rows of the parts it touches, or with all rows.

    The base is looked up first: if another load replaces it while the parts are
    read, the claim fails.
    """
    _finish(spark, folder)
    base = current_version(spark, folder)
    if base is None or stored is not None:
        return _publish(spark, merge(stored, batch), folder, key, base, whole=True)
    if _parts(spark, folder)[1] + 1 >= WHOLE_EVERY:
        return _publish(spark, merge(read_table(spark, folder), batch), folder, key, base, whole=True)
    batch = checkpoint(batch)  # read for its parts, for the ranges of keys and for the rows
    touched = [r.part for r in batch.select(_part(key).alias("part")).distinct().collect()]
    own = _read(spark, folder).where(F.col("part").isin(touched)).drop("part")
    return _publish(spark, merge(own, batch), folder, key, base)


def load_users(spark, rows, folder, loaded_at=None, stored=None):
    """Upsert ``rows`` into the user table in ``folder``; returns the path of the new version.

    ``stored``: the rows to merge with, if they are kept elsewhere (a relational table).
    """
    return _load(spark, rows, folder, "user_id", lambda old, new: upsert_users(old, new, loaded_at), stored)


def load_cells(spark, rows, folder, family):
    """Put ``rows`` into the cell table in ``folder``; returns the path of the new version."""
    return _load(spark, encode_cells(rows, family), folder, "row_key", merge_cells)


def jdbc_options(url, table, user=None, password=None, **options):
    """Reader and writer options of a relational user table.

    There are no default credentials. ``batchsize`` is the rows per statement
    batch; pass ``partitionColumn``, ``lowerBound``, ``upperBound`` and
    ``numPartitions`` to read in parallel.
    """
    merged = {"url": url, "dbtable": table, "batchsize": "1000", **options}
    if user is not None:
        merged["user"] = user
    if password is not None:
        merged["password"] = password
    return {key: str(value) for key, value in merged.items()}


def read_jdbc(spark, options, columns=None):
    """The relational table; filters and columns are pushed to the database."""
    table = spark.read.format("jdbc").options(**options).load()
    return table.select(*columns) if columns else table


def write_jdbc(users, options):
    """Replace the rows of the relational table, keeping its definition.

    ``users`` must be a published version that was merged with the table's rows: a
    job must not read the table it truncates. If writing fails, the version still
    has every row and can be written again.
    """
    users.write.format("jdbc").options(**options, truncate="true").mode("overwrite").save()
