"""Exact duplicates by deterministic naming of blocks.

Native: DataFrame functions only.

A text is cut into blocks of ``BLOCK`` bytes. Equal blocks get equal integer names and
different blocks different ones: blocks are sorted within the bucket of their hash, and a
name is the bucket with the block's rank there, so the hash only deals the sorting out and
nothing rests on it. Adjacent names are paired, pairs are named in the same way, and so
on until a document is one name; with its number of blocks that is its identity. Names
depend on the table alone, not on partitions, runs or lost executors.

A document with a name that occurs nowhere else equals no other and needs no further
names. Blocks of the ``HOT_KEYS`` most frequent buckets are named from a broadcast table of
their distinct blocks, so a block of a third of all documents is not one task's.

Defined results: a null text is empty and empty texts are equal; of equal texts the row
with the largest doc_id stays (a null one is least), of such rows the first read; rows of
one doc_id get a row each; an empty table gives an empty table; other columns are not read.
"""

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import HOT_KEYS, checkpoint, join_counted, whole_text

BLOCK = 1024  # bytes
BUCKET_BITS = 40
FEW = 64  # rows of a bucket that need no table


def named(rows, key):
    """``rows`` with ``name``, equal for equal ``key`` columns only, and ``alone``: no other row has it.

    rows: row, place (unique together), own (kept) and the key, which goes.
    """
    low = 64 - BUCKET_BITS
    rows = rows.withColumn("bucket", F.shiftrightunsigned(F.xxhash64(*key), low))

    def name(by):
        rank = F.dense_rank().over(by.orderBy(*key))
        fits = F.when(rank < 1 << low, rank).otherwise(F.raise_error(F.lit("a bucket has too many blocks")).cast("int"))
        return F.shiftleft("bucket", low).bitwiseOR(fits.cast("long"))

    often = rows.groupBy("bucket").agg(F.count("*").alias("n")).where(F.col("n") >= FEW)
    often = often.orderBy(F.desc("n"), "bucket").limit(HOT_KEYS).select("bucket")
    distinct = rows.join(F.broadcast(often), "bucket", "left_semi").groupBy("bucket", *key).agg(F.count("*").alias("known_n"))
    table = checkpoint(distinct.withColumn("known", name(Window.partitionBy("bucket"))))
    found = rows.join(F.broadcast(table), ["bucket", *key], "left")
    # Rows that have their name are dealt out anywhere, without the block.
    hot = F.col("known").isNotNull()
    dealt = found.select(
        "row", "place", "own", "bucket", "known", "known_n",
        F.when(hot, F.xxhash64("row", "place")).otherwise(F.col("bucket")).alias("deal"),
        *[F.when(~hot, F.col(k)).alias(k) for k in key],
    )
    by = Window.partitionBy("known", "deal")
    return dealt.select(
        "row", "place", "own",
        F.coalesce("known", name(by)).alias("name"),
        (F.coalesce("known_n", F.count("*").over(Window.partitionBy("known", "deal", *key))) == 1).alias("alone"),
    )


def _documents(rows):
    """One row per document, its names in order."""
    placed = F.array_sort(F.collect_list(F.struct("place", "name")))
    return rows.groupBy("row").agg(
        F.max("own").alias("own"),
        F.transform(placed, lambda x: x["name"]).alias("names"),
        F.max("alone").alias("alone"),
    )


def _blocks(docs, doc_id, text, block):
    """The blocks of all texts; ``own`` is set on the first one of each."""
    raw = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(f"`{doc_id}`").cast("long").alias("doc_id"),
        whole_text(f"`{text}`").cast("binary").alias("raw"),
    )
    count = F.greatest(F.ceil(F.octet_length("raw") / block).cast("int"), F.lit(1))
    own = F.struct("doc_id", F.sha2("raw", 256).alias("text_sha256"), count.alias("n_blocks"))
    cut = F.transform(
        F.sequence(F.lit(0), count - 1), lambda i: F.substring(F.col("raw"), i * block + 1, F.lit(block))
    )
    return raw.select("row", own.alias("own"), F.posexplode(cut).alias("place", "block")).withColumn(
        "own", F.when(F.col("place") == 0, F.col("own"))
    )


def identities(docs, doc_id="doc_id", text="text", block=BLOCK):
    """row, doc_id, text_sha256, n_blocks and name of every row; equal texts agree in the last two.

    ``name`` is null where the document has a name of its own and so equals no other.
    """
    at = checkpoint(_documents(named(_blocks(docs, doc_id, text, block), ["block"])))
    closed = []
    while True:
        done = F.col("alone") | (F.size("names") == 1)
        closed.append(at.where(done).select("row", "own.*", F.when(~F.col("alone"), F.col("names")[0]).alias("name")))
        rest = at.where(~done)
        if rest.isEmpty():
            break
        pairs = F.transform(
            F.sequence(F.lit(0), F.size("names") - 1, F.lit(2)),
            lambda i: F.struct(F.get("names", i).alias("left"), F.coalesce(F.get("names", i + 1), F.lit(0)).alias("right")),
        )
        paired = rest.select("row", "own", F.posexplode(pairs).alias("place", "pair")).select(
            "row", "place", F.when(F.col("place") == 0, F.col("own")).alias("own"), "pair.*"
        )
        at = checkpoint(_documents(named(paired, ["left", "right"])))
    found = closed[0]
    for more in closed[1:]:
        found = found.unionByName(more)
    return found


def exact_duplicates(docs, doc_id="doc_id", text="text", block=BLOCK):
    """doc_id, keep_id, group_size, kept and text_sha256 of every row."""
    found = identities(docs, doc_id, text, block)
    shared, identity = found.where("name IS NOT NULL"), ["n_blocks", "name"]
    groups = checkpoint(
        shared.groupBy(*identity).agg(
            F.max(F.struct("doc_id", (-F.col("row")).alias("first"))).alias("keep"), F.count("*").alias("n")
        )
    )
    # The size is needed besides the number that decides on the join.
    groups = groups.withColumn("group_size", F.col("n"))
    joined = join_counted(shared, groups, identity, "n", shared.count()).select(
        "doc_id",
        F.col("keep.doc_id").alias("keep_id"),
        "group_size",
        (F.col("keep.first") == -F.col("row")).alias("kept"),
        "text_sha256",
    )
    lone = found.where("name IS NULL").select(
        "doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), "text_sha256"
    )
    return joined.unionByName(lone)
