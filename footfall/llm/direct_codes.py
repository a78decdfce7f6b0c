"""Token ids in directly addressable codes.

An id is split into chunks of eight bits. Level 0 has the lowest chunk of every id, level
k the next one of those ids that have so many; a bitmap at each level says which ids go
on, and a directory of ranks (ones before every 512th bit) finds their place at the next
level. So any id is read in a few steps, without decoding others.

A segment is one such structure with the ids of consecutive documents, at most
``SEGMENT_IDS`` of them unless one document has more. Segments are rows of a Parquet
table, so they are committed by Spark and found on any store: part (range of documents),
seq, base (ids of the part before it), n_docs, n_ids, data.

Defined results: a null text is empty and gives its end id alone; a null doc_id sorts
first; rows of one doc_id keep their order of reading; an empty table gives an empty
table; other columns are not read.
"""

import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import small_batches, whole_text
from .pieces_table import portions
from .word_pieces import Words

SEGMENT_IDS = 1 << 20
BLOCK = 512  # bits between two ranks
HEAD = struct.Struct("<4sIQI")  # mark, documents, ids, levels
LEVEL = struct.Struct("<Q")  # chunks
MARK = b"DAC1"


def pack(doc_ids, lengths, ids):
    """A segment. doc_ids: integers or None; lengths: ids of each document; ids: unsigned."""
    n = len(doc_ids)
    nulls = np.array([x is None for x in doc_ids], np.uint8)
    keys = np.array([0 if x is None else x for x in doc_ids], "<i8")
    starts = np.zeros(n + 1, "<u8")
    np.cumsum(lengths, out=starts[1:])
    levels, rest = [], np.asarray(ids, np.uint32)
    while True:
        more = rest > 0xFF
        bits = np.packbits(more, bitorder="little")
        ones = np.add.reduceat(more, np.arange(0, len(more), BLOCK), dtype=np.int64) if len(more) else []
        ranks = np.zeros(len(ones) + 1, "<u4")
        np.cumsum(ones, out=ranks[1:])
        levels += [LEVEL.pack(len(rest)), (rest & 0xFF).astype(np.uint8).tobytes(), bits.tobytes(), ranks.tobytes()]
        if not more.any():
            break
        rest = rest[more] >> 8
    head = HEAD.pack(MARK, n, len(ids), len(levels) // 4)
    return b"".join([head, nulls.tobytes(), keys.tobytes(), starts.tobytes(), *levels])


class Segment:
    """A packed segment: documents, any id, or all ids of a document."""

    def __init__(self, data):
        mark, n, self.n_ids, levels = HEAD.unpack_from(data, 0)
        if mark != MARK:
            raise ValueError("not a segment")
        at = HEAD.size

        def take(kind, count):
            nonlocal at
            found = np.frombuffer(data, kind, count, at)
            at += found.nbytes
            return found

        nulls, keys = take(np.uint8, n), take("<i8", n)
        self.doc_ids = [None if a else int(b) for a, b in zip(nulls, keys, strict=True)]
        self.starts = take("<u8", n + 1).astype(np.int64)
        self.levels = []
        for _ in range(levels):
            (count,) = LEVEL.unpack_from(data, at)
            at += LEVEL.size
            self.levels.append(
                (take(np.uint8, count), take(np.uint8, -(-count // 8)), take("<u4", -(-count // BLOCK) + 1))
            )

    def at(self, i):
        """Id number ``i``: one chunk, one bit and one rank at each level."""
        found = 0
        for k, (chunks, bits, ranks) in enumerate(self.levels):
            found |= int(chunks[i]) << 8 * k
            if not bits[i // 8] >> i % 8 & 1:
                break
            block = i // BLOCK
            inside = np.unpackbits(bits[block * BLOCK // 8 : i // 8 + 1], bitorder="little")
            i = int(ranks[block]) + int(inside[: i - block * BLOCK].sum())
        return found

    def ids(self):
        """All ids, level by level from the highest."""
        above = None
        for k in reversed(range(len(self.levels))):
            chunks, bits, _ = self.levels[k]
            ids = chunks.astype(np.uint32)
            if above is not None:
                ids[np.unpackbits(bits, bitorder="little")[: len(ids)].astype(bool)] |= above << np.uint32(8)
            above = ids
        return above


def write(docs, path, tokenizer, end_id=1, doc_id="doc_id", text="text"):
    """Encode the texts in ascending order of ``doc_id`` and write segments to ``path``."""
    small_batches(docs.sparkSession)
    rows = docs.select(
        F.col(f"`{doc_id}`").cast("long").alias("doc_id"),
        F.monotonically_increasing_id().alias("row"),
        whole_text(f"`{text}`").alias("text"),
    )
    # Texts are dealt out before they are encoded: the order then costs no second encoding.
    ordered = rows.repartitionByRange("doc_id", "row").sortWithinPartitions("doc_id", "row")

    def run(batches):
        words, part = Words.of(tokenizer), TaskContext.get().partitionId()
        seq = base = 0
        held, size = [], 0

        def segment():
            ids = np.concatenate([x for _, x in held])
            lengths = [len(x) for _, x in held]
            data = pack([d for d, _ in held], lengths, ids)
            row = [[part], [seq], [base], [len(held)], [len(ids)], [data]]
            return pa.record_batch(
                [pa.array(x, t) for x, (_, t) in zip(row, fields, strict=True)], [n for n, _ in fields]
            )

        for batch in batches:
            keys, texts = batch.column(0).to_pylist(), batch.column(2).to_pylist()
            for first, last in portions(texts):
                for key, ids in zip(keys[first:last], words.encode(texts[first:last]), strict=True):
                    ids = np.append(ids, end_id).astype(np.uint32)
                    if held and size + len(ids) > SEGMENT_IDS:
                        yield segment()
                        seq, base, held, size = seq + 1, base + size, [], 0
                    held.append((key, ids))
                    size += len(ids)
        if held:
            yield segment()

    fields = [
        ("part", pa.int32()),
        ("seq", pa.int32()),
        ("base", pa.int64()),
        ("n_docs", pa.int32()),
        ("n_ids", pa.int64()),
        ("data", pa.binary()),
    ]
    schema = "part int, seq int, base long, n_docs int, n_ids long, data binary"
    ordered.mapInArrow(run, schema).write.option("compression", "zstd").parquet(path)


def read(spark, path):
    """One row per document of the segments at ``path``: doc_id, start, n_tokens, ids_crc32."""
    small_batches(spark)
    segments = spark.read.parquet(path)
    # One row per part, so as many as the writing job had tasks.
    parts = (
        segments.groupBy("part")
        .agg(F.sum("n_ids").alias("n"))
        .withColumn("before", F.sum("n").over(Window.orderBy("part")) - F.col("n"))
        .select("part", "before")
    )
    placed = segments.join(F.broadcast(parts), "part").select(
        (F.col("before") + F.col("base")).alias("start"), "data"
    )

    def run(batches):
        for batch in batches:
            for start, data in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                segment = Segment(data.as_buffer())
                ids = segment.ids().astype("<u4")
                cuts = segment.starts
                sums = [zlib.crc32(ids[a:b]) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
                yield pa.record_batch(
                    [
                        pa.array(segment.doc_ids, pa.int64()),
                        pa.array(start + cuts[:-1], pa.int64()),
                        pa.array(np.diff(cuts), pa.int64()),
                        pa.array(sums, pa.int64()),
                    ],
                    ["doc_id", "start", "n_tokens", "ids_crc32"],
                )

    return placed.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")
