"""SimHash near-duplicates by pigeonhole blocks.

A fingerprint has a bit for each bit of the shingle hashes: one if it is set in more than
half of them. Two fingerprints link if they differ in at most ``bits`` bits. With
``bits + 3`` blocks, linked fingerprints agree in at least three of them, so equal
fingerprints are merged first, each is posted once for every choice of three blocks, and
only those of one posting are compared. Each posting gives at most one link for each of
its fingerprints, to the smallest it is connected with there, never all pairs.

A posting may hold any number of fingerprints. The largest are known from exact counts
and the rest is watched while it streams by; what belongs to a posting of more than
``CROWD`` fingerprints goes another exact way: fingerprints at most ``bits`` apart are
those that can be made equal by changing at most half as many bits of each, so they are
grouped by all such changed forms, which are as many for every fingerprint.

Defined results: a null or empty text has fingerprint zero, which links like any other;
a text with fewer words than a shingle is one shingle; rows of one doc_id get a row each;
a null doc_id gets a component, but names it only if no other document is in it; an
empty table gives an empty table; other columns are not read.
"""

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from .common import checkpoint, join_counted, small_batches, whole_text
from .links import components

SEED = 42
AGREEING = 3  # blocks of a posting
CROWD = 4096  # fingerprints compared inside one posting
LARGEST = 10_000  # postings known to be crowded before the shuffle


def fingerprint(text, words=4):
    """The fingerprint of a text as an unsigned integer."""
    from xxhash import xxh64_intdigest

    found = text.encode().lower().split()  # of bytes: A-Z and ASCII white space only
    if not found:
        return 0
    joined = b" ".join(found)
    ends = np.cumsum([len(w) + 1 for w in found]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    count = max(1, len(found) - words + 1)
    last = ends[-count:].tolist()
    ones = np.zeros(64, np.int64)
    for first in range(0, count, 1 << 17):
        spans = zip(starts[first : first + (1 << 17)].tolist(), last[first : first + (1 << 17)], strict=False)
        hashes = np.array([xxh64_intdigest(joined[a:b], SEED) for a, b in spans], "<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > count, bitorder="little").view("<u8")[0])


def fingerprints(docs, words=4, doc_id="doc_id", text="text", keep=None):
    """doc_id, fingerprint (as a signed 64-bit integer) and the column ``keep`` (a long) of every row."""
    small_batches(docs.sparkSession)
    rows = docs.select(
        F.col(f"`{doc_id}`").cast("long").alias("doc_id"),
        (F.col(f"`{keep}`") if keep else F.lit(None)).cast("long").alias("keep"),
        whole_text(f"`{text}`").alias("text"),
    )

    def run(batches):
        for batch in batches:
            found = np.array([fingerprint(t, words) for t in batch.column(2).to_pylist()], np.uint64)
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array(found.view(np.int64))], ["doc_id", "keep", "fp"])

    return rows.mapInArrow(run, "doc_id long, keep long, fp long")


def _masks(bits):
    """A mask for each choice of three of the bits + 3 blocks, which are as even as can be."""
    edges = np.linspace(0, 64, bits + AGREEING + 1).round().astype(int)
    blocks = [sum(1 << b for b in range(a, e)) for a, e in zip(edges[:-1], edges[1:], strict=True)]
    masks = [sum(chosen) for chosen in combinations(blocks, AGREEING)]
    return [m - (1 << 64) if m >= 1 << 63 else m for m in masks]


def _forest(found, bits):
    """For each of the fingerprints, the index of the first one it is connected with."""
    n = len(found)
    near = np.empty((n, n), bool)
    for a in range(0, n, 256):
        near[a : a + 256] = np.bitwise_count(found[a : a + 256, None] ^ found[None]) <= bits
    label = np.arange(n)
    while True:
        new = np.empty_like(label)
        for a in range(0, n, 256):
            new[a : a + 256] = np.where(near[a : a + 256], label[None], n).min(axis=1)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _compare(bits, crowd):
    """Batches sorted by (choice, key, fp) to links (a < b) and, with b null, crowded fingerprints."""

    def links(fp, cuts):
        sizes = np.diff(cuts)
        first = cuts[:-1][sizes == 2]
        a, b = fp[first], fp[first + 1]
        close = np.bitwise_count(a ^ b) <= bits
        low, high = [a[close]], [b[close]]
        for i in np.flatnonzero(sizes > 2):
            group = fp[cuts[i] : cuts[i + 1]]
            label = _forest(group, bits)
            moved = label != np.arange(len(group))
            low.append(group[label[moved]])
            high.append(group[moved])
        return np.concatenate(low), np.concatenate(high)

    def rows(low, high=None):
        high = pa.nulls(len(low), pa.int64()) if high is None else pa.array(high.view(np.int64))
        return pa.record_batch([pa.array(low.view(np.int64)), high], ["a", "b"])

    def run(batches):
        held = (np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.uint64))
        over = None  # the posting that is known to be crowded
        for batch in batches:
            new = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(3)]
            choice, key = (np.concatenate([h, x]) for h, x in zip(held[:2], new[:2], strict=True))
            fp = np.concatenate([held[2], new[2].astype(np.int64).view(np.uint64)])
            if over is not None:
                more = (choice == over[0]) & (key == over[1])
                if more.any():
                    yield rows(fp[more])
                    choice, key, fp = choice[~more], key[~more], fp[~more]
            if not len(fp):
                held = (choice, key, fp)
                continue
            step = np.flatnonzero((choice[1:] != choice[:-1]) | (key[1:] != key[:-1])) + 1
            cuts = np.concatenate([[0], step, [len(fp)]])
            sizes = np.diff(cuts)
            for i in np.flatnonzero(sizes > crowd):
                yield rows(fp[cuts[i] : cuts[i + 1]])
            if sizes[-1] > crowd:
                over, last = (choice[-1], key[-1]), len(fp)
            else:
                last = cuts[-2]
            held = (choice[last:], key[last:], fp[last:])
            small = np.repeat(sizes <= crowd, sizes)[:last] if last else np.zeros(0, bool)
            kept = fp[:last][small]
            ends = np.cumsum(sizes[(sizes <= crowd) & (cuts[1:] <= last)])
            low, high = links(kept, np.concatenate([[0], ends]).astype(int))
            if len(low):
                yield rows(low, high)
        if len(held[2]) > 1:
            low, high = links(held[2], np.array([0, len(held[2])]))
            if len(low):
                yield rows(low, high)

    return run


def links(distinct, bits=4, crowd=CROWD):
    """Links (a, b) that connect exactly the fingerprints that links at ``bits`` bits connect.

    distinct: one row per fingerprint, in the column fp.
    """
    if bits % 2:
        raise ValueError("an even number of bits")
    small_batches(distinct.sparkSession)
    posted = distinct.select(
        "fp",
        F.explode(
            F.array(
                *[
                    F.struct(F.lit(i).alias("choice"), F.col("fp").bitwiseAND(F.lit(m)).alias("key"))
                    for i, m in enumerate(_masks(bits))
                ]
            )
        ).alias("p"),
    ).select(F.col("p.choice").cast("long").alias("choice"), "p.key", "fp")
    # At most LARGEST rows, each with more than crowd postings.
    crowded = F.broadcast(
        posted.groupBy("choice", "key").count().where(F.col("count") > crowd).orderBy(F.desc("count")).limit(LARGEST)
    )
    at = ["choice", "key"]
    compared = (
        posted.join(crowded, at, "left_anti")
        .repartition(*at)
        .sortWithinPartitions(*at, "fp")
        .mapInArrow(_compare(bits, crowd), "a long, b long")
    )
    compared = checkpoint(compared)
    full = (
        compared.where("b is null")
        .select(F.col("a").alias("fp"))
        .unionByName(posted.join(crowded, at, "left_semi").select("fp"))
        .distinct()
    )
    flips = [0]
    for n in range(1, bits // 2 + 1):
        flips += [sum(1 << b for b in c) for c in combinations(range(64), n)]
    flips = [m - (1 << 64) if m >= 1 << 63 else m for m in flips]
    changed = full.select(
        "fp", F.explode(F.transform(F.lit(flips), lambda m: F.col("fp").bitwiseXOR(m))).alias("form")
    )
    lowest = changed.groupBy("form").agg(F.min("fp").alias("low"), F.count("*").alias("n")).where("n > 1")
    other = changed.join(lowest, "form").where("fp <> low").select(F.col("low").alias("a"), F.col("fp").alias("b"))
    return compared.where("b is not null").unionByName(other).distinct()


def near_duplicates(docs, bits=4, words=4, doc_id="doc_id", text="text", crowd=CROWD, keep=None):
    """doc_id, fingerprint (16 hexadecimal digits) and component_id (least doc_id reachable).

    ``keep`` names a further column of integers to carry along, as ``keep``.
    """
    prints = checkpoint(fingerprints(docs, words, doc_id, text, keep))
    distinct = checkpoint(prints.groupBy("fp").agg(F.min("doc_id").alias("first"), F.count("*").alias("n")))
    roots = components(links(distinct, bits, crowd))  # node, root: all but the lone ones
    linked = checkpoint(
        distinct.join(roots, distinct["fp"] == roots["node"]).select("fp", "root", "first", "n")
    )
    # A component may hold very many fingerprints, and a fingerprint very many documents.
    least = linked.groupBy("root").agg(F.min("first").alias("least"), F.count("*").alias("size"))
    named = join_counted(linked.select("fp", "root"), least, "root", "size", linked.count())
    named = named.select("fp", "least")
    all_named = checkpoint(
        distinct.join(named, "fp", "left").select("fp", F.coalesce("least", "first").alias("component_id"), "n")
    )
    return join_counted(prints, all_named, "fp", "n", prints.count()).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id", *(["keep"] if keep else [])
    )
