"""Ranked lexical search by the NRA algorithm (no random access).

Documents are dealt out, never their postings: a shard is the posting lists of some
documents of one task, each list sorted by falling impact. An item reads its lists in
step, only forwards. A document's score lies between the impacts seen so far and those plus
the next unread impact of every list it was not seen in. Documents whose upper end is
below the k-th lower end go. A list is read on while a document left was not seen in it,
until all that are left, ties included, have one number. So the best of a shard are
exact, and the best of all shards are the best of all documents.

Items are worked off in blocks of about ``ITEM_TERMS`` terms, whose terms, weights and
numbers of documents are all that a task holds of them.

Defined results: a null or empty text has no terms, so a document of it is never found and
an item of it finds nothing; every row of the items is an item of its own, also if rows
share an id; documents of one id are found each; a null doc_id comes last among equal
scores; empty tables give an empty table; other columns are not read.
"""

import math
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import checkpoint, small_batches, whole_text
from .pieces_table import list_array

BEST = 50
ITEM_TERMS = 1_000_000  # terms of a block of items
SHARD = 2_000_000  # postings of a shard
FIRST = 256  # postings of each list read in the first step
MERGERS = 64  # tasks that share the results of one item

# Every byte to itself, A-Z to lower case, other ASCII but letters and digits to a space.
_BYTES = bytes(c if c > 127 or chr(c).isalnum() else 32 for c in range(256)).lower()


def terms_of(text):
    """The terms of a text as UTF-8, with repeats."""
    return text.encode().translate(_BYTES).split()


def weight(n_docs, df):
    """Of a term that ``df`` of ``n_docs`` documents hold."""
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def resolve(lists, n_docs, k, first=FIRST):
    """Documents that may be among the k best, ties included, and their exact scores.

    lists: (documents, impacts) pairs, impacts positive and falling, a document once in each.
    """
    lower = np.zeros(n_docs, np.int64)
    left = np.zeros(n_docs, bool)  # once no unseen document can come in: those still in question
    closed = False
    read = [0] * len(lists)
    going = list(range(len(lists)))
    step = first
    while going:
        for t in going:
            docs, impacts = lists[t]
            part = slice(read[t], read[t] + step)
            lower[docs[part]] += impacts[part]
            read[t] = min(read[t] + step, len(docs))
        step *= 4
        going = [t for t in going if read[t] < len(lists[t][0])]
        heads = {t: int(lists[t][1][read[t]]) for t in going}
        ahead = sum(heads.values())
        least = max(1, int(np.partition(lower, n_docs - k)[n_docs - k])) if n_docs > k else 1
        if not closed and ahead >= least:
            continue
        upper = lower + ahead
        for t in going:
            upper[lists[t][0][: read[t]]] -= heads[t]
        left = (upper >= least) & (left if closed else lower > 0)
        closed = True
        # A list in which all that are left were seen holds nothing for them.
        number = int(left.sum())
        going = [t for t in going if int(left[lists[t][0][: read[t]]].sum()) < number]
    found = np.flatnonzero(left if closed else lower > 0)
    return found, lower[found]


def _counted(vocabulary):
    """Batches of doc_id and text to doc_id, n, and the terms of the vocabulary with their occurrences."""

    def run(batches):
        get = vocabulary.value.get
        for batch in batches:
            sizes, terms, times = [], [], []
            for text in batch.column(1).to_pylist():
                words = terms_of(text)
                found = Counter(map(get, words))
                found.pop(None, None)
                sizes.append(len(words))
                terms.append(np.fromiter(found.keys(), np.int32, len(found)))
                times.append(np.fromiter(found.values(), np.int32, len(found)))
            yield pa.record_batch(
                [batch.column(0), pa.array(sizes, pa.int64()), list_array(terms), list_array(times)],
                ["doc_id", "n", "terms", "times"],
            )

    return run


def _searched(items, weights, n_docs, n_terms, k, shard):
    """Batches of _counted to the k best of each shard: item, item_id, doc_id, score, task."""

    def best(held):
        ids = np.concatenate([h[0] for h in held])
        null = np.concatenate([h[1] for h in held])
        n = np.concatenate([h[2] for h in held])
        sizes = np.concatenate([h[3] for h in held])
        term, times = (np.concatenate([h[i] for h in held]).astype(np.int64) for i in (4, 5))
        doc = np.repeat(np.arange(len(ids)), sizes)
        m = 50 + 50 * n * n_docs // n_terms
        impact = weights.value[term] * (1_000_000_000 * times // (1000 * times + 20 * m[doc]))
        order = np.lexsort((-impact, term))[: len(term)]
        order = order[impact[order] > 0]
        doc, impact, term = doc[order], impact[order], term[order]
        starts = np.searchsorted(term, np.arange(len(weights.value) + 1))
        out = [[], [], [], []]
        for item, item_id, own in items.value:
            lists = [
                (doc[starts[t] : starts[t + 1]], impact[starts[t] : starts[t + 1]])
                for t in own
                if starts[t] < starts[t + 1]
            ]
            found, scores = resolve(lists, len(ids), k)
            top = np.lexsort((ids[found], null[found], -scores))[:k]
            found, scores = found[top], scores[top]
            out[0] += [item] * len(found)
            out[1] += [item_id] * len(found)
            out[2].append(pa.array(ids[found], pa.int64(), mask=null[found]))
            out[3].append(scores)
        docs = pa.concat_arrays(out[2]) if out[2] else pa.array([], pa.int64())
        scores = np.concatenate(out[3]) if out[3] else np.empty(0, np.int64)
        task = pa.array(np.full(len(docs), TaskContext.get().partitionId()), pa.int64())
        return pa.record_batch(
            [pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), docs, pa.array(scores, pa.int64()), task],
            ["item", "item_id", "doc_id", "score", "task"],
        )

    def run(batches):
        held, size = [], 0
        for batch in batches:
            ids = batch.column(0)
            terms, times = batch.column(2), batch.column(3)
            held.append(
                (
                    ids.fill_null(0).to_numpy(),
                    ids.is_null().to_numpy(zero_copy_only=False),
                    batch.column(1).to_numpy(),
                    np.diff(terms.offsets.to_numpy()),
                    terms.flatten().to_numpy(),
                    times.flatten().to_numpy(),
                )
            )
            size += len(held[-1][4])
            if size >= shard:
                yield best(held)
                held, size = [], 0
        if size:
            yield best(held)

    return run


def _item_blocks(items, item_id, text, most):
    """Lists of (item, item_id, terms), one block at a time."""

    def run(batches):
        for batch in batches:
            terms = [sorted(set(terms_of(t))) for t in batch.column(2).to_pylist()]
            yield pa.record_batch(
                [batch.column(0), batch.column(1), pa.array(terms, pa.list_(pa.binary()))], ["item", "item_id", "terms"]
            )

    rows = items.select(
        F.monotonically_increasing_id().alias("item"),
        F.col(f"`{item_id}`").cast("long").alias("item_id"),
        whole_text(f"`{text}`").alias("text"),
    )
    rows = checkpoint(rows.mapInArrow(run, "item long, item_id long, terms array<binary>").where(F.size("terms") > 0))
    blocks = -(-(rows.agg(F.sum(F.size("terms"))).first()[0] or 0) // most)
    for block in range(blocks):
        yield rows.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == block).orderBy("item").collect()


def search(docs, items, k=BEST, doc_id="doc_id", text="text", item_id="item_id", item_text="text", most=ITEM_TERMS, shard=SHARD):
    """item_id, rank, doc_id and score of the k best documents of every item."""
    spark = docs.sparkSession
    context = spark.sparkContext
    small_batches(spark)
    texts = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), whole_text(f"`{text}`").alias("text"))
    found = spark.createDataFrame([], "item long, item_id long, doc_id long, score long, task long")
    for block in _item_blocks(items, item_id, item_text, most):
        vocabulary = {}
        own = [(r.item, r.item_id, [vocabulary.setdefault(bytes(t), len(vocabulary)) for t in r.terms]) for r in block]
        counted = checkpoint(
            texts.mapInArrow(
                _counted(context.broadcast(vocabulary)), "doc_id long, n long, terms array<int>, times array<int>"
            )
        )
        n_docs, n_terms = counted.where("n > 0").agg(F.count("*"), F.sum("n")).first()
        df = np.zeros(len(vocabulary), np.int64)
        # As many rows as the block has terms.
        for term, n in counted.select(F.explode("terms").alias("term")).groupBy("term").count().collect():
            df[term] = n
        weights = np.array([weight(n_docs, n) for n in df.tolist()], np.int64)
        run = _searched(context.broadcast(own), context.broadcast(weights), n_docs, n_terms, k, shard)
        found = found.unionByName(
            counted.where("n > 0").mapInArrow(run, "item long, item_id long, doc_id long, score long, task long")
        )
    order = [F.desc("score"), F.asc_nulls_last("doc_id"), "task"]
    # The best of a number of tasks first: the results of one item are not one task's either.
    merged = found.withColumn("merger", F.pmod("task", F.lit(MERGERS)))
    merged = merged.withColumn("rank", F.row_number().over(Window.partitionBy("item", "merger").orderBy(*order)))
    merged = merged.where(F.col("rank") <= k)
    ranked = merged.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order)))
    return ranked.where(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")
