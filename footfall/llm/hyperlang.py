"""Language identification by hyperdimensional profiles.

Every letter has a random vector of plus and minus ones, derived from its code point
alone. Three letters in a row are bound into one vector: the product of their vectors,
each rotated by its distance from the end. The vectors of all trigrams of a text add up to
its profile; the profiles of a language's texts add up to the language's prototype. A text
gets the language whose prototype has the greatest cosine with its profile.

Runs of characters other than letters count as one blank, as do both ends of the text.

Prototypes are learnt from about ``SAMPLE`` texts a language at most, chosen by a hash of
the id, for every language. Everything else covers all texts. A prototype takes 8 KB on the
driver; tasks compare with one block of ``BLOCK`` prototypes after the other, 16 MB each.

Defined results: a text that is null or has no letter gets ``und`` with score 0, as does
every text if nothing could be learnt; equal cosines go to the first language in order;
repeated rows get a row each; an empty table gives an empty table; other columns are not
read. The score is the cosine, 0 where it is negative.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from .common import small_batches, whole_text
from .pieces_table import portions

SIZE = 1024  # components of a vector
SAMPLE = 4000
BLOCK = 2048
SEED = 20
UNKNOWN = "und"
STEP = 1 << 21  # above any code point


class Profiles:
    """Letter vectors and the profiles of texts."""

    def __init__(self):
        self.letters, self.table = {}, np.empty((0, SIZE), np.int8)
        # 0: not looked at yet, 1: letter, 2: other
        self.kinds = np.zeros(0x110000, np.int8)

    def rows(self, code_points):
        """Rows of the letters in the table, which grows as needed."""
        new = [c for c in code_points.tolist() if c not in self.letters]
        if new:
            signs = [np.random.default_rng([SEED, c]).integers(0, 2, SIZE, np.int8) * 2 - 1 for c in new]
            self.letters.update((c, len(self.table) + i) for i, c in enumerate(new))
            self.table = np.concatenate([self.table, np.array(signs, np.int8)])
        return np.array([self.letters[c] for c in code_points.tolist()])

    def sequence(self, text):
        """Code points of the lower-case letters, 0 for blanks; empty if there is no letter."""
        points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        kinds = self.kinds[points]
        if (kinds == 0).any():
            for c in np.unique(points[kinds == 0]).tolist():
                self.kinds[c] = 1 if chr(c).isalpha() else 2
            kinds = self.kinds[points]
        letter = kinds == 1
        if not letter.any():
            return points[:0]
        found = np.concatenate([[0], np.where(letter, points, 0), [0]])
        return found[np.concatenate([[True], (found[1:] != 0) | (found[:-1] != 0)])]

    def vectors(self, trigrams):
        """The bound vector of each trigram."""
        parts = [trigrams // STEP**2, trigrams // STEP % STEP, trigrams % STEP]
        bound = np.ones((len(trigrams), SIZE), np.int8)
        for k, part in enumerate(parts):
            letters, at = np.unique(part, return_inverse=True)
            rows = self.rows(letters)
            bound *= np.roll(self.table[rows], 2 - k, axis=1)[at]
        return bound

    def profiles(self, texts):
        """A row for each text, zero without letters."""
        out = np.zeros((len(texts), SIZE), np.float32)
        counted = []
        for text in texts:
            s = self.sequence(text)
            counted.append(np.unique(s[:-2] * STEP**2 + s[1:-1] * STEP + s[2:], return_counts=True))
        known = np.unique(np.concatenate([t for t, _ in counted])) if counted else np.empty(0, np.int64)
        for first in range(0, len(known), 16384):  # bounds the vectors held at once
            part = known[first : first + 16384]
            bound = self.vectors(part).astype(np.float32)
            for i, (trigrams, counts) in enumerate(counted):
                a, b = np.searchsorted(trigrams, [part[0], part[-1] + 1])
                if b > a:
                    out[i] += counts[a:b].astype(np.float32) @ bound[np.searchsorted(part, trigrams[a:b])]
        return out


def learn(docs, lang="lang", doc_id="doc_id", text="text"):
    """Languages in order and their prototypes (one row each) from labelled ``docs``."""
    rows = docs.select(
        F.col(f"`{lang}`").cast("string").alias("lang"),
        F.col(f"`{doc_id}`").cast("string").alias("key"),
        F.col(f"`{text}`").alias("text"),
    ).where("lang is not null and text is not null")
    # A small row for each language, of which the driver holds a prototype later.
    rates = rows.groupBy("lang").agg((F.lit(float(SAMPLE)) / F.count("*")).alias("rate"))
    place = F.pmod(F.xxhash64("key"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    sample = rows.join(F.broadcast(rates), "lang").where(place < F.col("rate")).select("lang", "text")
    small_batches(docs.sparkSession)

    def record(sums):
        totals = pa.array([x.tolist() for x in sums.values()], pa.list_(pa.float64()))
        return pa.record_batch([pa.array(list(sums)), totals], ["lang", "total"])

    def run(batches):
        own, sums = Profiles(), {}
        for batch in batches:
            langs, texts = (c.to_pylist() for c in batch.columns)
            for first, end in portions(texts):
                found = own.profiles(texts[first:end]).astype(np.float64)
                for name, row in zip(langs[first:end], found, strict=True):
                    sums[name] = sums.get(name, 0) + row
            if len(sums) >= BLOCK:
                yield record(sums)
                sums = {}
        if sums:
            yield record(sums)

    def add(batches):
        sums = {}
        for batch in batches:
            for name, total in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                sums[name] = sums.get(name, 0) + np.asarray(total.values)
        if sums:
            yield record(sums)

    # Texts are profiled where they are read; only sums of profiles are shuffled, and each
    # language lies in one partition. They are whole numbers, so their order changes nothing.
    schema = "lang string, total array<double>"
    found = sample.mapInArrow(run, schema).repartition("lang").mapInArrow(add, schema).collect()
    found = sorted((r["lang"], r["total"]) for r in found)
    return [name for name, _ in found], np.array([total for _, total in found]).reshape(-1, SIZE)


def identify(docs, langs, prototypes, doc_id="doc_id", text="text"):
    """doc_id, lang_pred and score of every row."""
    spark = docs.sparkSession
    length = np.linalg.norm(prototypes, axis=1, keepdims=True)
    unit = np.divide(prototypes, length, out=np.zeros_like(prototypes), where=length > 0)
    firsts = range(0, max(len(langs), 1), BLOCK)
    blocks = [spark.sparkContext.broadcast((langs[f : f + BLOCK], unit[f : f + BLOCK])) for f in firsts]
    small_batches(spark)
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), whole_text(f"`{text}`").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    found = f"doc_id {kind}, lang_pred string, score double"

    def best(profiles, names, prototype, size):
        if not names:
            return [UNKNOWN] * len(profiles), np.zeros(len(profiles))
        cosines = profiles @ prototype.T / np.where(size > 0, size, 1)[:, None]
        at = cosines.argmax(axis=1)
        preds = [names[b] if s > 0 else UNKNOWN for b, s in zip(at, size, strict=True)]
        return preds, np.clip(np.where(size > 0, cosines.max(axis=1), 0), 0, 1)

    def first_block(batches):
        own, (names, prototype) = Profiles(), blocks[0].value
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for first, end in portions(texts):
                profiles = own.profiles(texts[first:end])
                size = np.linalg.norm(profiles.astype(np.float64), axis=1)
                preds, scores = best(profiles.astype(np.float64), names, prototype, size)
                columns = [batch.column(0)[first:end], pa.array(preds, pa.string()), pa.array(scores)]
                if len(blocks) > 1:
                    columns.append(pa.FixedSizeListArray.from_arrays(profiles.ravel(), SIZE).cast(pa.list_(pa.float32())))
                yield pa.record_batch(columns, ["doc_id", "lang_pred", "score", "profile"][: len(columns)])

    if len(blocks) == 1:
        return rows.mapInArrow(first_block, found)
    carried = rows.mapInArrow(first_block, f"{found}, profile array<float>")
    for k in range(1, len(blocks)):

        def next_block(batches, block=blocks[k]):
            names, prototype = block.value
            for batch in batches:
                profiles = batch.column(3).flatten().to_numpy().reshape(-1, SIZE).astype(np.float64)
                old = batch.column(1).to_pylist(), batch.column(2).to_numpy()
                new = best(profiles, names, prototype, np.linalg.norm(profiles, axis=1))
                # Equal cosines stay with the earlier language.
                better = new[1] > old[1]
                preds = [b if x else a for a, b, x in zip(old[0], new[0], better, strict=True)]
                scores = np.where(better, new[1], old[1])
                columns = [batch.column(0), pa.array(preds, pa.string()), pa.array(scores), batch.column(3)]
                yield pa.record_batch(columns, ["doc_id", "lang_pred", "score", "profile"])

        carried = carried.mapInArrow(next_block, carried.schema)
    return carried.drop("profile")
