"""Minimal perfect hashing of distinct 64-bit keys in blocks, with the keys kept to verify.

A block is a cascade of bit fields. A key alone at its position of a field sets the bit
there; keys that meet others go on to the next field. A key's index is the number of bits
set before its own, so the indexes of a block are 0 to one less than its keys.
"""

import numpy as np

SLOT_BITS = 24
ROOM = 2  # positions for each key of a field

_FACTOR = np.uint64(0x9E3779B97F4A7C15)


def _mixed(keys, salt):
    x = (keys ^ np.uint64((salt + 1) * 0xD1342543DE82EF95 % (1 << 64))) * _FACTOR
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def slots(keys):
    """A number below 2 ** SLOT_BITS for each key; blocks are slots modulo their number."""
    return (_mixed(keys, -1 + (1 << 20)) >> np.uint64(64 - SLOT_BITS)).astype(np.int64)


def fields(keys):
    """The packed bit fields of distinct keys."""
    made, rest = [], keys
    while len(rest):
        size = ROOM * len(rest) + 7 & ~7
        at = (_mixed(rest, len(made)) % np.uint64(size)).astype(np.int64)
        alone = np.bincount(at, minlength=size) == 1
        made.append(np.packbits(alone, bitorder="little").tobytes())
        rest = rest[~alone[at]]
    return made


class Block:
    """Finds the index of keys; ``keys`` are in the order of their indexes."""

    def __init__(self, made, keys=None):
        self.fields, self.keys, before = [], keys, 0
        for packed in made:
            bits = np.unpackbits(np.frombuffer(packed, np.uint8), bitorder="little").astype(bool)
            ranks = np.cumsum(bits, dtype=np.int32) + np.int32(before - 1)
            before += int(bits.sum())
            self.fields.append((bits, ranks))
        self.size = before

    def index(self, keys):
        """The index of each key; of a key that is not in the block any index or -1."""
        found, rest = np.full(len(keys), -1), np.arange(len(keys))
        for level, (bits, ranks) in enumerate(self.fields):
            at = (_mixed(keys[rest], level) % np.uint64(len(bits))).astype(np.int64)
            hit = bits[at]
            found[rest[hit]] = ranks[at[hit]]
            rest = rest[~hit]
        return found

    def verified(self, keys):
        """The index of each key, -1 for keys that are not in the block."""
        found = self.index(keys)
        found[(found >= 0) & (self.keys[found] != keys)] = -1
        return found


def build(keys):
    """(fields, keys in index order) of distinct keys."""
    made = fields(keys)
    ordered = np.empty_like(keys)
    ordered[Block(made).index(keys)] = keys
    return made, ordered


class Blocks:
    """Some of ``number`` blocks, by their place."""

    def __init__(self, number, made):
        self.number, self.made = number, made
        self.starts, total = {}, 0
        for place, block in made.items():
            self.starts[place] = total
            total += block.size
        self.size = total

    def find(self, keys):
        """A place in all keys of these blocks for each key, -1 for others."""
        found = np.full(len(keys), -1)
        places = slots(keys) % self.number
        order = np.argsort(places, kind="stable")
        cuts = np.flatnonzero(np.diff(places[order], prepend=-1, append=-1))
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            own, place = order[a:b], int(places[order[a]])
            if place in self.made:
                index = self.made[place].verified(keys[own])
                found[own] = np.where(index >= 0, index + self.starts[place], -1)
        return found
