"""Greedy word-piece counts by a linear longest-match automaton.

The vocabulary's byte strings form a trie. Each node has a failure link, the node to go on
from when no child fits, and the number of tokens that are complete by then. So a word is
counted in one pass, in time linear in its bytes, and no piece is ever built.

A word is a run of characters other than ASCII white space, with a blank before it: pieces
that start with a blank start words, all others go on. Every single byte is a token, so
every word has pieces.

All words of a batch go through the automaton together, a byte at a time, each different
word once. Where only ``FEW`` of them have bytes left, these go on one by one, which takes
the same steps in less time.

Defined results: a null or empty text has no words and no tokens; repeated rows get a row
each; an empty table gives an empty table; other columns are not read.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from .byte_pieces import read_ranks
from .common import small_batches, whole_text
from .pieces_table import portions

ROOT = 0
NONE = -1
FEW = 64


class Automaton:
    """Trie, failure links and popped counts of a set of byte strings."""

    made = {}

    def __init__(self, tokens):
        children, ends = [{}], [False]
        for token in tokens:
            node = ROOT
            for byte in token:
                if byte not in children[node]:
                    children[node][byte] = len(children)
                    children.append({})
                    ends.append(False)
                node = children[node][byte]
            ends[node] = True
        if any(b not in children[ROOT] or not ends[children[ROOT][b]] for b in range(256)):
            raise ValueError("every single byte must be a token")
        self.fail, self.popped = np.full(len(children), NONE, np.int32), np.zeros(len(children), np.int32)
        level = [(ROOT, b, n) for b, n in children[ROOT].items()]
        while level:  # by length
            below = []
            for parent, byte, node in level:
                if ends[node]:
                    self.fail[node], self.popped[node] = ROOT, 1
                else:
                    at, popped = int(self.fail[parent]), int(self.popped[parent])
                    while at != NONE and byte not in children[at]:
                        popped += int(self.popped[at])
                        at = int(self.fail[at])
                    if at != NONE:
                        self.fail[node], self.popped[node] = children[at][byte], popped
                below += [(node, b, n) for b, n in children[node].items()]
            level = below
        self.links = self.fail.tolist(), self.popped.tolist()
        # Children as one sorted table of node * 256 + byte.
        edges = sorted((node * 256 + b, n) for node, own in enumerate(children) for b, n in own.items())
        self.edges = np.array([e for e, _ in edges], np.int64)
        self.targets = np.array([n for _, n in edges], np.int32)
        self.next = dict(edges)

    @classmethod
    def of(cls, path):
        if path not in cls.made:
            cls.made[path] = cls(sorted(read_ranks(path)))
        return cls.made[path]

    def child(self, nodes, data):
        """The child of each node by a byte, NONE where there is none."""
        key = nodes.astype(np.int64) * 256 + data
        at = np.minimum(np.searchsorted(self.edges, key), len(self.edges) - 1)
        return np.where(self.edges[at] == key, self.targets[at], NONE)

    def walk(self, node, tokens, data):
        """State and count after the bytes ``data``."""
        following, fail, popped = self.next, self.links[0], self.links[1]
        for byte in data:
            new = following.get(node << 8 | byte)
            while new is None:
                tokens += popped[node]
                node = fail[node]
                new = following.get(node << 8 | byte)
            node = new
        return node, tokens

    def count(self, words):
        """Number of greedy longest-match tokens of each byte string."""
        n = len(words)
        sizes = np.fromiter(map(len, words), np.int64, n)
        order = np.argsort(-sizes, kind="stable")
        flat = np.frombuffer(b"".join(words), np.uint8)
        starts = (np.cumsum(sizes) - sizes)[order]
        ordered = sizes[order]
        state, tokens = np.zeros(n, np.int32), np.zeros(n, np.int64)
        falling = -ordered
        for i in range(int(ordered[0]) if n else 0):
            # Words are in order of size: the first ones still have a byte.
            live = int(np.searchsorted(falling, -i, side="left"))
            if live <= FEW:
                for k in range(live):
                    at, found = self.walk(int(state[k]), int(tokens[k]), words[order[k]][i:])
                    state[k], tokens[k] = at, found
                break
            data = flat[starts[:live] + i].astype(np.int64)
            new = self.child(state[:live], data)
            stuck = np.flatnonzero(new == NONE)
            while len(stuck):
                at = state[stuck]
                tokens[stuck] += self.popped[at]
                state[stuck] = self.fail[at]
                new[stuck] = self.child(state[stuck], data[stuck])
                stuck = stuck[new[stuck] == NONE]
            state[:live] = new
        # What is left at the end of each word.
        rest = np.flatnonzero(state != ROOT)
        while len(rest):
            at = state[rest]
            tokens[rest] += self.popped[at]
            state[rest] = self.fail[at]
            rest = rest[state[rest] != ROOT]
        out = np.empty(n, np.int64)
        out[order] = tokens
        return out


def word_lengths(docs, path, doc_id="doc_id", text="text"):
    """doc_id, n_words and n_tokens of every row."""
    small_batches(docs.sparkSession)
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), whole_text(f"`{text}`").alias("text"))

    def run(batches):
        automaton = Automaton.of(path)
        for batch in batches:
            texts, n_words, n_tokens = batch.column(1).to_pylist(), [], []
            for first, end in portions(texts):
                split = [t.encode().split() for t in texts[first:end]]
                different = list(set().union(*split))
                known = dict(zip(different, automaton.count([b" " + w for w in different]).tolist(), strict=True))
                n_words += map(len, split)
                n_tokens += [sum(map(known.__getitem__, words)) for words in split]
            yield pa.record_batch(
                [batch.column(0), pa.array(n_words, pa.int64()), pa.array(n_tokens, pa.int64())],
                ["doc_id", "n_words", "n_tokens"],
            )

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, n_words long, n_tokens long")
