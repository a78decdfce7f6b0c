"""Nearest neighbours by a permutation index.

Pivots are a sample of the vectors whose number grows with the square root of theirs
(``pivot_count``; the first by a hash of the id, of four times as many looked at for different
ones). A vector is posted in the inverted files of its ``POSTED`` nearest pivots. Its
permutation is the order of the first ``RANKED`` pivots by distance.

A query visits the files of its nearest pivots. What it meets there for the first time is
ranked by footrule, the sum over pivots of the difference of their places in both orders;
vectors up to a cut, and at least as many as are asked for of each piece of a file, are
reranked by their distance on the original vectors in double precision.

How many files are visited and where the footrule is cut is measured on the table: the true
neighbours of ``SAMPLE`` vectors among all rows are found by brute force, and both numbers
are chosen such that a share of ``RECALL`` of them is met, and as many are below the cut. A
query visits more files where its own hold too few vectors for a full answer.

A file is dealt out over keys by its size, so no vector, however often repeated, fills one
task.

Defined results: vectors that are null, zero, or hold a null or non-finite component take
no part, neither do rows with a null id; if lengths differ, those of the most frequent
length (the smallest of several) take part; rows of one id count each, but for a query's
own id; equal distances go to the smaller id; an empty table gives an empty result; other
columns are not read.
"""

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import checkpoint, small_batches

FEWEST, MOST = 256, 16_384  # pivots
RANKED = 128  # of them in a permutation; places fit a byte, sums 16 bits
POSTED = 3
SAMPLE = 128
RECALL = 0.98
PIECE = 1024  # vectors in a piece of an inverted file
QUERIES = 256  # queries compared with a piece at once
POSTINGS_PER_KEY = 50_000
CELLS = 1 << 22  # distances to pivots held at once


def pivot_count(n):
    """The number of pivots for ``n`` vectors."""
    return min(max(FEWEST, math.isqrt(n)), MOST)


def valid(vectors, vec_id="vec_id", embedding="embedding"):
    """vec_id and vector (array of doubles) of the rows that take part."""
    rows = vectors.select(
        F.col(f"`{vec_id}`").cast("long").alias("vec_id"),
        F.col(f"`{embedding}`").cast("array<double>").alias("vector"),
    )
    finite = ~F.exists(
        "vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf")))
    )
    rows = rows.where(
        F.col("vec_id").isNotNull() & finite & F.exists("vector", lambda x: x != 0)
    )
    sizes = rows.groupBy(F.size("vector").alias("n")).count().orderBy(F.desc("count"), "n").limit(1).collect()
    return rows.where(F.size("vector") == (sizes[0]["n"] if sizes else 0)), sizes[0]["count"] if sizes else 0


def choose_pivots(rows, most):
    """At most ``most`` different vectors, as a matrix."""
    first = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(4 * most).collect()
    different = list(dict.fromkeys(tuple(r["vector"]) for r in first))[:most]
    return np.array(different, np.float64)


def distances(vectors, pivots):
    """Squared distances to the pivots, less a number of each vector's own."""
    return (pivots**2).sum(axis=1)[None] - 2 * vectors @ pivots.T


def _nearest_first(away, most):
    """The ``most`` nearest pivots of each row, nearest first."""
    if most >= away.shape[1]:
        return np.argsort(away, axis=1, kind="stable")
    near = np.sort(np.argpartition(away, most, axis=1)[:, :most], axis=1)
    order = np.argsort(np.take_along_axis(away, near, axis=1), axis=1, kind="stable")
    return np.take_along_axis(near, order, axis=1)


def places(away):
    """The place of each of the first ``RANKED`` pivots in the order of each row."""
    order = np.argsort(away[:, :RANKED], axis=1, kind="stable")
    found = np.empty(order.shape, np.uint8)
    np.put_along_axis(found, order, np.arange(order.shape[1], dtype=np.uint8)[None], axis=1)
    return found


def footrule(many, one):
    """Footrule of each column of ``many`` (16-bit places, a row a pivot) and ``one``."""
    return np.abs(many - one[:, None]).sum(axis=0, dtype=np.int16)


def _binary(rows):
    return pa.array([x.tobytes() for x in rows], pa.binary())


ORDERED = "vec_id long, vector binary, places binary, files binary"


def _ordered(rows, pivots, kind):
    """Vectors as bytes of numpy type ``kind``, places, and the files each is posted in."""
    share = rows.sparkSession.sparkContext.broadcast(pivots)

    def run(batches):
        own = share.value
        step = max(1, CELLS // len(own))
        for batch in batches:
            for at in range(0, batch.num_rows, step):
                part = batch.slice(at, step)
                column = part.column(1)
                found = column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)
                away = distances(found, own)
                files = _nearest_first(away, POSTED).astype("<i2")
                made = [part.column(0), _binary(found.astype(kind)), _binary(places(away)), _binary(files)]
                yield pa.record_batch(made, ["vec_id", "vector", "places", "files"])

    return rows.mapInArrow(run, ORDERED)


def calibrate(ordered, pivots, kind, count):
    """Files to visit and the greatest footrule to rerank, from true neighbours of a sample."""
    spark = ordered.sparkSession
    m, dimension = pivots.shape
    picked = ordered.orderBy(F.xxhash64("vec_id", F.lit(1)), "vec_id").limit(SAMPLE).collect()
    ids = [r["vec_id"] for r in picked]
    own = np.array([np.frombuffer(r["vector"], kind) for r in picked], np.float64)
    away = distances(own, pivots)
    place = np.empty((len(ids), m), np.int32)
    np.put_along_axis(place, _nearest_first(away, m), np.arange(m, dtype=np.int32)[None], axis=1)
    share = spark.sparkContext.broadcast((ids, own, place, places(away).astype(np.int16)))

    def run(batches):
        names, vectors, at, orders = share.value
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = batch.column(0).to_numpy()
            own_rows = np.frombuffer(b"".join(batch.column(1).to_pylist()), kind).reshape(-1, dimension)
            held = np.frombuffer(b"".join(batch.column(2).to_pylist()), np.uint8).reshape(len(rows), -1)
            posted = np.frombuffer(b"".join(batch.column(3).to_pylist()), "<i2").reshape(len(rows), -1)
            out = []
            for i, name in enumerate(names):
                apart = ((own_rows - vectors[i]) ** 2).sum(axis=1)
                other = np.flatnonzero(rows != name)
                best = other[np.lexsort((rows[other], apart[other]))[:count]]
                rule = footrule(held[best].T.astype(np.int16), orders[i])
                first = at[i][posted[best]].min(axis=1) if len(best) else best
                out += zip([i] * len(best), rows[best].tolist(), apart[best].tolist(), first.tolist(), rule.tolist())
            if out:
                yield pa.record_batch(
                    [pa.array(x) for x in zip(*out)], ["q", "vec_id", "apart", "first", "footrule"]
                )

    near = ordered.mapInArrow(run, "q long, vec_id long, apart double, first long, footrule long")
    rank = F.row_number().over(Window.partitionBy("q").orderBy("apart", "vec_id"))
    # SAMPLE * count rows.
    true = near.withColumn("rank", rank).where(F.col("rank") <= count).select("first", "footrule").collect()
    if not true:
        return min(POSTED, m), 0
    first, rule = np.array(true).T
    at = lambda values: int(np.quantile(values, RECALL, method="higher"))
    return at(first) + 1, at(rule)


def _visits(rows, pivots, kind, sizes, probed, count):
    """The files each query visits, as bytes and as an array."""
    share = rows.sparkSession.sparkContext.broadcast((pivots, sizes))

    def run(batches):
        own, held = share.value
        step = max(1, CELLS // len(own))
        for batch in batches:
            for at in range(0, batch.num_rows, step):
                part = batch.slice(at, step)
                found = [np.frombuffer(x, kind) for x in part.column(1).to_pylist()]
                order = _nearest_first(distances(np.array(found, np.float64), own), len(own))
                # A vector is in POSTED files, so these hold count others at least.
                enough = (np.cumsum(held[order], axis=1) < POSTED * (count + 1)).sum(axis=1) + 1
                visited = [o[: max(probed, e)].astype("<i2") for o, e in zip(order, enough, strict=True)]
                made = [*part.columns[:3], _binary(visited), pa.array([v.tolist() for v in visited], pa.list_(pa.int32()))]
                yield pa.record_batch(made, ["vec_id", "vector", "places", "files", "pivots"])

    return rows.mapInArrow(run, ORDERED + ", pivots array<int>")


PACKED = "pivot int, key int, ids binary, vectors binary, places binary, files array<binary>"


def _pieces(size):
    """Rows sorted by key packed into pieces of ``size``."""

    def piece(key, rows):
        ids, vectors, orders, files = zip(*rows, strict=True)
        made = [[key[0]], [key[1]], [np.array(ids, "<i8").tobytes()], [b"".join(vectors)], [b"".join(orders)], [files]]
        kinds = [pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.list_(pa.binary())]
        return pa.record_batch(
            [pa.array(x, t) for x, t in zip(made, kinds, strict=True)],
            ["pivot", "key", "ids", "vectors", "places", "files"],
        )

    def run(batches):
        at, held = None, []
        for batch in batches:
            for pivot, key, *row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if held and ((pivot, key) != at or len(held) == size):
                    yield piece(at, held)
                    held = []
                at = (pivot, key)
                held.append(row)
        if held:
            yield piece(at, held)

    return run


def _search(pivots, dimension, kind, cut, count):
    """Pairs of a file's piece and a piece of queries to the nearest found there."""

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                p = row["pivot"]
                ids = np.frombuffer(row["ids"], "<i8")
                vectors = np.frombuffer(row["vectors"], kind).reshape(-1, dimension)
                orders = np.frombuffer(row["places"], np.uint8).reshape(len(ids), -1)
                orders = np.ascontiguousarray(orders.T).astype(np.int16)
                posted = np.frombuffer(b"".join(row["files"]), "<i2").reshape(len(ids), -1)
                q_ids = np.frombuffer(row["q_ids"], "<i8")
                out = ([], [], [])
                for q, own, order, files in zip(
                    q_ids,
                    np.frombuffer(row["q_vectors"], kind).reshape(-1, dimension).astype(np.float64),
                    np.frombuffer(row["q_places"], np.uint8).reshape(len(q_ids), -1).astype(np.int16),
                    row["q_files"],
                    strict=True,
                ):
                    visited = np.frombuffer(files, "<i2")
                    at = np.full(pivots, pivots, np.int32)
                    at[visited] = np.arange(len(visited))
                    # Those of an earlier file of this query were met there.
                    new = np.flatnonzero((at[posted] >= at[p]).all(axis=1) & (ids != q))
                    rule = footrule(orders[:, new], order)
                    some = new[rule <= cut]
                    if len(some) < count:
                        some = new[np.argsort(rule, kind="stable")[:count]]
                    apart = np.sqrt(((vectors[some] - own) ** 2).sum(axis=1))
                    first = np.lexsort((ids[some], apart))[:count]
                    out[0].append(np.full(len(first), q))
                    out[1].append(ids[some][first])
                    out[2].append(apart[first])
                if sum(map(len, out[0])):
                    yield pa.record_batch([pa.array(np.concatenate(x)) for x in out], ["query_id", "vec_id", "score"])

    return run


def nearest(vectors, is_query, count=10, vec_id="vec_id", embedding="embedding"):
    """query_id, rank, vec_id and score (distance) of the ``count`` nearest found of each query.

    is_query: a condition on vec_id. Queries are a stated set; each is compared with the
    pieces of the files that it visits.
    """
    spark = vectors.sparkSession
    rows, n = valid(vectors, vec_id, embedding)
    if not n:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    small_batches(spark)
    pivots = choose_pivots(rows, pivot_count(n))
    m, dimension = pivots.shape
    single = vectors.schema[embedding].dataType.elementType.simpleString() == "float"
    kind = "<f4" if single else "<f8"
    ordered = checkpoint(_ordered(rows, pivots, kind))
    probed, cut = calibrate(ordered, pivots, kind, count)

    # A file is one of two bytes, lowest first.
    file = lambda i: F.conv(F.hex(F.concat(*[F.substring("files", 2 * i + b, 1) for b in (2, 1)])), 16, 10)
    posted = F.array(*[file(i).cast("int") for i in range(min(POSTED, m))])
    sizes = np.zeros(m, np.int64)
    # One row a file.
    for r in ordered.select(F.explode(posted).alias("pivot")).groupBy("pivot").count().collect():
        sizes[r["pivot"]] = r["count"]
    keys = F.array(*[F.lit(int(k)) for k in np.maximum(1, -(-sizes // POSTINGS_PER_KEY))])[F.col("pivot")]

    def packed(rows, size):
        return (
            rows.select(
                "pivot", F.pmod(F.hash("vec_id"), keys).alias("key"), "vec_id", "vector", "places", "files"
            )
            .repartition("pivot", "key")
            .sortWithinPartitions("pivot", "key")
            .mapInArrow(_pieces(size), PACKED)
        )

    files = packed(ordered.withColumn("pivot", F.explode(posted)), PIECE)
    asked = _visits(ordered.where(is_query), pivots, kind, sizes, probed, count)
    asked = packed(asked.withColumn("pivot", F.explode("pivots")), QUERIES).select(
        "pivot",
        F.explode(F.sequence(F.lit(0), keys - 1)).alias("key"),
        *[F.col(c).alias(f"q_{c}") for c in ("ids", "vectors", "places", "files")],
    )
    found = files.join(asked, ["pivot", "key"]).mapInArrow(
        _search(m, dimension, kind, cut, count), "query_id long, vec_id long, score double"
    )
    ranked = found.withColumn(
        "rank", F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    )
    return ranked.where(F.col("rank") <= count).select("query_id", "rank", "vec_id", "score")
