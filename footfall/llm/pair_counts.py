"""Alignment of two tokenizers with the corpus-wide counts of linked id pairs.

Tokens of A and B link where their byte ranges overlap. The first pass counts links by pair
within tasks. The distinct pairs get a minimal perfect hash, in blocks of about
``BLOCK_PAIRS``; every partition of partial counts becomes dense vectors, one a block,
indexed by the hash; vectors are summed ``FAN`` at a time, in a tree. The second pass aligns
the documents again and looks their pairs up, each verified by the key kept at its index.

A task holds the hash and counts of at most ``ROUND`` blocks. Where there are more pairs,
vectors and second pass run in rounds, each with its own blocks, and sums are added.

Defined results: a null or empty text, and one whose joined token bytes are not a space and
the text, has no tokens and zeros; rows of one doc_id get a row each; a null doc_id
stays null; an empty table gives an empty table; other columns are not read.
"""

import collections
import hashlib
import itertools

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import functions as F

from .common import checkpoint, small_batches, whole_text
from .perfect_hash import Block, Blocks, build, slots
from .pieces_table import portions
from .token_spans import KNOWN, Aligned, Spans, stretches

BLOCK_PAIRS = 1 << 16
ROUND = 64  # blocks: four million pairs, 64 MB
FAN = 16  # vectors added by one task

SUMS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]


class _Parts:
    """Indexes of the different parts of texts; ``learn`` is called with the new ones."""

    def __init__(self, learn):
        self.learn = learn
        self.clear()

    def clear(self):
        self.known = collections.defaultdict(itertools.count().__next__)  # a new part gets the next index

    def indexes(self, texts):
        """An index array for each text; ``learn`` gets the new parts and the index of their first."""
        known, before = self.known, len(self.known)
        found = []
        for text in texts:
            parts = stretches(text) if text else []
            found.append(np.fromiter(map(known.__getitem__, parts), np.int64, len(parts)))
        if len(known) > before:
            self.learn(list(itertools.islice(known, before, None)), before)
        return found


def _summed(keys, times):
    """Different keys and the sum of their times."""
    found, at = np.unique(keys, return_inverse=True)
    total = np.zeros(len(found), np.int64)
    np.add.at(total, at, times)
    return found, total


def _partials(paths):
    """Batches of texts to pairs with the number of their links, a part of it at a time."""

    def run(batches):
        spans = Spans.of(*paths)
        learnt, valid, times = [], [], np.zeros(0, np.int64)

        def learn(new, before):
            found = Aligned(spans, new)
            learnt.append((found.keys(), found.part + before))
            valid.append(found.valid)

        def counted():
            keys, part = (np.concatenate(x) for x in zip(*learnt, strict=True))
            used = times[part] > 0
            found, total = _summed(keys[used], times[part][used])
            return pa.record_batch(
                [pa.array(found.view(np.int64)), pa.array(slots(found)), pa.array(total)], ["pair", "slot", "n"]
            )

        parts = _Parts(learn)
        for batch in batches:
            texts = batch.column(0).to_pylist()
            for first, last in portions(texts):
                found = parts.indexes(texts[first:last])
                good = np.concatenate(valid) if valid else np.zeros(0, bool)
                valid[:] = [good]
                times = np.concatenate([times, np.zeros(len(good) - len(times), np.int64)])
                kept = [x for x in found if good[x].all()]
                if kept:
                    times += np.bincount(np.concatenate(kept), minlength=len(times))
                if len(parts.known) > KNOWN:
                    yield counted()
                    learnt, valid, times = [], [], np.zeros(0, np.int64)
                    parts.clear()
        if learnt:
            yield counted()

    return run


def _hashed(batches):
    """Rows (block, pair), sorted, to the hash of each block."""
    at, held = None, []

    def made():
        found, keys = build(np.concatenate(held).view(np.uint64))
        return pa.record_batch(
            [pa.array([at], pa.int64()), pa.array([found], pa.list_(pa.binary())), pa.array([keys.tobytes()])],
            ["block", "fields", "keys"],
        )

    for batch in batches:
        blocks, pairs = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        cuts = [0, *(np.flatnonzero(np.diff(blocks)) + 1).tolist(), len(blocks)]
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            if a < b:
                if held and blocks[a] != at:
                    yield made()
                    held = []
                at = int(blocks[a])
                held.append(pairs[a:b])
    if held:
        yield made()


def _vectors(blocks):
    """Batches of pair and n to one dense vector a block that the task has pairs of."""

    def run(batches):
        table = blocks.value
        total, any_ = np.zeros(table.size, np.int64), False
        for batch in batches:
            at = table.find(batch.column(0).to_numpy().view(np.uint64))
            if (at < 0).any():
                raise ValueError("a pair that has no hash")
            np.add.at(total, at, batch.column(1).to_numpy())
            any_ = True
        lane = TaskContext.get().partitionId()
        for place, block in table.made.items() if any_ else ():
            own = total[table.starts[place] : table.starts[place] + block.size]
            if own.any():
                yield pa.record_batch(
                    [pa.array([place], pa.int64()), pa.array([lane], pa.int64()), pa.array([own.tobytes()])],
                    ["block", "lane", "counts"],
                )

    return run


def _added(batches):
    """Rows (block, lane, counts), sorted, to their sum for each block and lane."""
    at, total = None, None

    def made():
        return pa.record_batch(
            [pa.array([at[0]], pa.int64()), pa.array([at[1]], pa.int64()), pa.array([total.tobytes()])],
            ["block", "lane", "counts"],
        )

    for batch in batches:
        for *here, counts in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if at is not None and here != at:
                yield made()
                total = None
            counts = np.frombuffer(counts, np.int64)
            total = counts.copy() if total is None else total + counts
            at = here
    if at is not None:
        yield made()


def _tree_sum(vectors):
    """One vector a block."""
    vectors = checkpoint(vectors)
    while (vectors.agg(F.max("lane")).first()[0] or 0) > 0:
        fanned = vectors.withColumn("lane", F.expr(f"lane DIV {FAN}")).repartition("block", "lane")
        vectors = checkpoint(
            fanned.sortWithinPartitions("block", "lane").mapInArrow(_added, "block long, lane long, counts binary")
        )
    return vectors.select("block", "counts")


def _highest(batches):
    """Rows (keys, counts) to the highest count of each B id among them."""
    for batch in batches:
        for keys, counts in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            b = np.frombuffer(keys, np.uint64) & np.uint64(0xFFFFFFFF)
            order = np.lexsort((np.frombuffer(counts, np.int64), b))
            last = order[np.flatnonzero(np.diff(b[order], append=np.uint64(1 << 32)))]
            yield pa.record_batch(
                [pa.array(b[last].astype(np.int64)), pa.array(np.frombuffer(counts, np.int64)[last])], ["b", "n"]
            )


def _looked_up(paths, table, best):
    """Batches of row, doc_id and text to the alignment of each, with counts of the pairs of the table."""

    def run(batches):
        spans = Spans.of(*paths)
        blocks, counts = table.value
        sums, valid, notations = np.zeros((0, len(SUMS)), np.int64), np.zeros(0, bool), []
        only = len(blocks.made) == blocks.number
        lacking = set()  # parts with pairs that were not counted; only texts without tokens have any

        def learn(new, before):
            nonlocal sums, valid
            found = Aligned(spans, new)
            keys, back = np.unique(found.keys(), return_inverse=True)
            at = blocks.find(keys)
            if only:  # else pairs may belong to another round
                lacking.update((found.part[at[back] < 0] + before).tolist())
            n = np.where(at >= 0, counts[at], 0) if len(counts) else np.zeros(len(keys), np.int64)
            is_best = (at >= 0) & (n == best.value[(keys & np.uint64(0xFFFFFFFF)).astype(np.int64)])
            own = np.zeros((len(new), len(SUMS)), np.int64)
            own[:, :4] = np.stack([found.n_a, found.n_b, found.n_groups, found.n_links], axis=1)
            for column, values in ((4, is_best), (5, n)):
                running = np.concatenate([[0], np.cumsum(values[back])])
                own[:, column] = np.diff(running[np.concatenate([[0], np.cumsum(found.n_links)])])
            sums, valid = np.concatenate([sums, own]), np.concatenate([valid, found.valid])
            notations.extend(found.notations())

        parts = _Parts(learn)
        for batch in batches:
            texts = batch.column(2).to_pylist()
            for first, last in portions(texts):
                rows, digests = [], []
                for at in parts.indexes(texts[first:last]):
                    if len(at) and valid[at].all():
                        if lacking and not lacking.isdisjoint(at.tolist()):
                            raise ValueError("a pair that was not counted")
                        rows.append(sums[at].sum(axis=0))
                        digests.append(hashlib.sha256(";".join(map(notations.__getitem__, at.tolist())).encode()).hexdigest())
                    else:
                        rows.append(np.zeros(len(SUMS), np.int64))
                        digests.append("")
                rows = np.stack(rows)
                yield pa.record_batch(
                    [
                        batch.column(0)[first:last],
                        batch.column(1)[first:last],
                        *[pa.array(rows[:, i]) for i in range(len(SUMS))],
                        pa.array(digests),
                    ],
                    ["row", "doc_id", *SUMS, "groups_sha256"],
                )
                if len(parts.known) > KNOWN:
                    sums, valid, notations = np.zeros((0, len(SUMS)), np.int64), np.zeros(0, bool), []
                    lacking.clear()
                    parts.clear()

    return run


def pair_counts(docs, a_path, b_path, text="text", block_pairs=BLOCK_PAIRS, per_round=ROUND):
    """The counted pairs in hashed blocks: (number of blocks, rows of block, fields, keys, counts)."""
    context = docs.sparkSession.sparkContext
    small_batches(docs.sparkSession)
    texts = docs.select(whole_text(f"`{text}`").alias("text"))
    partials = checkpoint(texts.mapInArrow(_partials((a_path, b_path)), "pair long, slot long, n long"))
    pairs = checkpoint(partials.select("pair", "slot").distinct())
    number = max(1, -(-pairs.count() // block_pairs))
    block = F.pmod("slot", F.lit(number)).alias("block")
    hashed = checkpoint(
        pairs.select(block, "pair")
        .repartition("block")
        .sortWithinPartitions("block", "pair")
        .mapInArrow(_hashed, "block long, fields array<binary>, keys binary")
    )
    vectors = None
    for first in range(0, number, per_round):
        own = (F.col("block") >= first) & (F.col("block") < first + per_round)
        made = hashed.where(own).collect()  # at most per_round blocks
        blocks = Blocks(number, {r.block: Block(r.fields, np.frombuffer(r.keys, np.uint64)) for r in made})
        part = partials.select("pair", "n", block).where(own).select("pair", "n")
        part = _tree_sum(part.mapInArrow(_vectors(context.broadcast(blocks)), "block long, lane long, counts binary"))
        vectors = part if vectors is None else vectors.unionByName(part)
    return number, checkpoint(hashed.join(vectors, "block"))


def align(docs, a_path, b_path, doc_id="doc_id", text="text", block_pairs=BLOCK_PAIRS, per_round=ROUND):
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256 of every row."""
    spark = docs.sparkSession
    context = spark.sparkContext
    number, counted = pair_counts(docs, a_path, b_path, text, block_pairs, per_round)
    best = np.zeros(Spans.of(a_path, b_path).b_words, np.int64)
    found = counted.select("keys", "counts").mapInArrow(_highest, "b long, n long").groupBy("b").agg(F.max("n").alias("n"))
    for b, n in found.collect():  # a row for each id of B
        best[b] = n
    best = context.broadcast(best)
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(f"`{doc_id}`").cast("long").alias("doc_id"),
        whole_text(f"`{text}`").alias("text"),
    )
    if number > per_round:  # rows have to have the same number in every round
        rows = checkpoint(rows)
    rounds = []
    for first in range(0, number, per_round):
        made = counted.where((F.col("block") >= first) & (F.col("block") < first + per_round)).orderBy("block").collect()
        blocks = Blocks(number, {r.block: Block(r.fields, np.frombuffer(r.keys, np.uint64)) for r in made})
        counts = np.concatenate([np.frombuffer(r.counts, np.int64) for r in made] or [np.empty(0, np.int64)])
        table = context.broadcast((blocks, counts))
        kinds = ", ".join(f"{name} long" for name in ("row", "doc_id", *SUMS)) + ", groups_sha256 string"
        rounds.append(rows.mapInArrow(_looked_up((a_path, b_path), table, best), kinds))
    found = rounds[0]
    if len(rounds) > 1:
        for more in rounds[1:]:
            found = found.unionByName(more)
        kept = [c for c in found.columns if c not in ("row", "n_best", "count_sum")]
        found = found.groupBy("row").agg(
            *[F.first(c).alias(c) for c in kept], F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum")
        )
    return found.select("doc_id", *SUMS, "groups_sha256")
