"""Packing by optimal length buckets.

The number of documents of each length, over the whole table, decides the buckets: dynamic
programming finds the boundaries with the least padding, where every document is padded to
the greatest length of its bucket. In each bucket, documents in order of a hash fill
batches of as many as a budget of padded tokens allows, at least one.

The histogram has a row for each different length, however long. Different lengths add up to
at most all tokens, so there are at most ``sqrt(2 * tokens)`` of them: the driver sees 7 million
for 25 trillion tokens at the worst, and no more than the longest document has tokens.

Batch places come from counts: rows are ranked inside groups of about ``GROUP`` rows and
the groups of a bucket are numbered one after the other, so no task sorts a bucket.

Defined results: a null length counts as 0; lengths below 1 are packed as 1; rows of equal
length always share a bucket; repeated rows are packed each; an empty table gives an empty
table; columns are kept but for those that have the name of a result, which are replaced.
Documents of equal hash and key are the same to a batch: which one comes first is open.
"""

import numpy as np
from pyspark.sql import functions as F
from pyspark.sql.window import Window

BUCKETS = 16
BUDGET = 65_536
GROUP = 50_000


def _layer(best, before, high, layer):
    """Costs with one more bucket, and the first length of the last bucket, for each last length.

    Divide and conquer, where all middles of a depth are solved at once: the best start
    of a middle bounds those of both sides.
    """
    n = len(high)
    new, cut = np.full(n, np.inf), np.zeros(n, np.int64)
    first, last = np.array([layer]), np.array([n - 1])
    low, top = first, last
    while len(first):
        i = (first + last) // 2
        width = np.minimum(i, top) - low + 1
        starts = np.cumsum(width) - width
        at = np.repeat(np.arange(len(i)), width)
        j = np.arange(len(at)) + (low - starts)[at]
        cost = best[j - 1] + (before[i + 1][at] - before[j]) * high[i][at]
        new[i] = np.minimum.reduceat(cost, starts)
        least = np.flatnonzero(cost == new[i][at])
        _, earliest = np.unique(at[least], return_index=True)
        cut[i] = j[least[earliest]]
        first, last = np.concatenate([first, i + 1]), np.concatenate([i - 1, last])
        low, top = np.concatenate([low, cut[i]]), np.concatenate([cut[i], top])
        left = first <= last
        first, last, low, top = first[left], last[left], low[left], top[left]
    return new, cut


def optimal_bounds(lengths, counts, buckets=BUCKETS):
    """Upper bounds, at most ``buckets`` of them, with the least total padded length.

    lengths: ascending; every bound is one of them. The cost of a bucket satisfies the
    quadrangle inequality, so each layer is solved by divide and conquer.
    """
    n = len(lengths)
    if n <= buckets:
        return [int(x) for x in lengths]
    before = np.concatenate([[0], np.cumsum(np.asarray(counts, np.float64))])
    high = np.asarray(lengths, np.float64)
    best = before[1:] * high  # one bucket over the first i + 1 lengths
    chosen = []
    for layer in range(1, buckets):
        best, cut = _layer(best, before, high, layer)
        chosen.append(cut)
    bounds, i = [], n - 1
    for cut in reversed(chosen):
        bounds.append(int(lengths[i]))
        i = int(cut[i]) - 1
    return [*reversed([*bounds, int(lengths[i])])]


def pack(rows, length, buckets=BUCKETS, budget=BUDGET, key="doc_id"):
    """``rows`` with bucket, padded_length, batch (in the bucket) and place (in the batch)."""
    names = ("bucket", "padded_length", "batch", "place")
    kept = [c for c in rows.columns if c.lower() not in names]
    held = rows.select(
        F.struct(*[F.col(f"`{c}`") for c in kept]).alias("_row"),
        F.greatest(F.coalesce(F.col(f"`{length}`").cast("long"), F.lit(0)), F.lit(1)).alias("_n"),
        F.col(f"`{key}`").alias("_key"),
    )
    # Bounded as the module says.
    histogram = held.groupBy("_n").count().toArrow().sort_by("_n")
    if not len(histogram):
        return rows.select(*kept).withColumns(
            {n: F.lit(0).cast("int" if n == "bucket" else "long") for n in names}
        )
    lengths, numbers = (histogram.column(c).to_numpy() for c in ("_n", "count"))
    bounds = optimal_bounds(lengths, numbers, buckets)
    counts = np.zeros(len(bounds), np.int64)
    np.add.at(counts, np.searchsorted(bounds, lengths), numbers)
    table = F.array(*[F.lit(x) for x in bounds])
    bucket = F.lit(len(bounds) - 1)
    for i in reversed(range(len(bounds) - 1)):
        bucket = F.when(F.col("_n") <= bounds[i], i).otherwise(bucket)
    groups = F.array(*[F.lit(-(-c // GROUP)) for c in counts.tolist()])
    dealt = held.withColumn("bucket", bucket).withColumn("_hash", F.xxhash64("_key", "_n"))
    dealt = dealt.withColumn("_group", F.pmod("_hash", groups[F.col("bucket")]))
    # Ranks need the keys alone; whole rows are dealt out once.
    ranked = dealt.withColumn(
        "_rank", F.row_number().over(Window.partitionBy("bucket", "_group").orderBy("_hash", "_key")) - 1
    )
    sizes = (
        dealt.groupBy("bucket", "_group")
        .count()
        .withColumn(
            "_before",
            F.sum("count").over(Window.partitionBy("bucket").orderBy("_group")) - F.col("count"),
        )
        .select("bucket", "_group", "_before")
    )
    placed = ranked.join(sizes, ["bucket", "_group"])
    per = F.greatest(F.floor(F.lit(budget) / table[F.col("bucket")]), F.lit(1)).cast("long")
    at = F.col("_before") + F.col("_rank")
    return placed.select(
        "_row.*",
        F.col("bucket").cast("int").alias("bucket"),
        table[F.col("bucket")].cast("long").alias("padded_length"),
        F.floor(at / per).cast("long").alias("batch"),
        (at % per).cast("long").alias("place"),
    )
