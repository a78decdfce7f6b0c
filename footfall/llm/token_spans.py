"""Tokens of two tokenizers over the same bytes, stretch by stretch.

A is a byte-level BPE file of the tokenizers library, B a sentencepiece BPE model; both
read a space and the text. Neither has tokens that reach from a character that is no white
space into a blank or line feed, so a text is cut there, and each different stretch
is encoded once, many at a time. The cuts are properties of the two vocabularies that
``Spans`` checks where it can.
"""

import os
import re

import numpy as np

# Stretches of texts whose white space is blanks and line feeds, and cuts of all others. Where
# blanks and line feeds stand alone, a mark is put before each and the text is split at that.
_MARK = "\0"
_RUNS = ["  ", "\n\n", " \n", "\n ", _MARK]
_PLAIN = re.compile("[ \n]+[^ \n]+|[ \n]+$")
_ODD = [c for c in map(chr, range(0x3001)) if c.isspace() and c not in " \n"]
_CUT = re.compile(r"(?<=\S)(?=[ \n])")
SPACE = "▁"
CHUNK = 50_000  # characters encoded together
KNOWN = 500_000  # stretches a task remembers


def stretches(text):
    """The parts of a space and the text."""
    whole = " " + text
    if any(map(whole.__contains__, _ODD)):
        return _CUT.split(whole)
    if whole.endswith((" ", "\n")) or any(map(whole.__contains__, _RUNS)):
        return _PLAIN.findall(whole)
    return whole.replace(" ", _MARK + " ").replace("\n", _MARK + "\n").split(_MARK)[1:]


def _byte_characters():
    """The character that stands for each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class Spans:
    """Encoder of both; built once per Python worker and pair of files."""

    made = {}

    def __init__(self, a_path, b_path):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True  # their strings are ordinary text
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        self.b_words = self.b.get_piece_size()
        pieces = [self.b.id_to_piece(i) for i in range(self.b_words)]
        if any(re.search(f"[^{SPACE}]{SPACE}", p) or re.search("[ \n]", p) for p in pieces):
            raise ValueError("B has pieces that reach over a blank or line feed")
        self.b_bytes = [
            bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(SPACE, " ").encode()
            for i, p in enumerate(pieces)
        ]
        byte = _byte_characters()
        vocabulary = self.a.get_vocab(with_added_tokens=False)
        self.a_bytes = [b""] * (self.a.get_vocab_size() + 1)
        for token, i in vocabulary.items():
            self.a_bytes[i] = bytes(byte.get(c, 63) for c in token)
        self.a_sizes = np.array([len(x) for x in self.a_bytes])
        self.b_sizes = np.array([len(x) for x in self.b_bytes])
        # Tokens of "a", which is put before strings so that the model adds its blank there.
        self.lead = len(self.b.encode("a"))

    @classmethod
    def of(cls, *paths):
        if paths not in cls.made:
            cls.made[paths] = cls(*paths)
        return cls.made[paths]

    def _both(self, wholes):
        """For each string, which begins with a blank or line feed: both id lists."""
        a = [x.ids for x in self.a.encode_batch_fast(wholes, add_special_tokens=False)]
        b = self.b.encode(["a" + w for w in wholes], num_threads=1)
        return a, [ids[self.lead :] for ids in b]

    def _fits(self, whole, a, b):
        raw = whole.encode()
        return b"".join(map(self.a_bytes.__getitem__, a)) == raw == b"".join(map(self.b_bytes.__getitem__, b))

    def encode(self, parts):
        """Both id arrays of all parts with the number of ids of each, and which parts are the bytes of their tokens.

        A part that is not has no tokens.
        """
        sizes = np.fromiter(map(len, parts), np.int64, len(parts))
        bytes_ = np.fromiter(map(len, map(str.encode, parts)), np.int64, len(parts))
        apart = np.fromiter([p[-1].isspace() or SPACE in p for p in parts], bool, len(parts)) | (sizes > CHUNK)
        alone, usual = np.flatnonzero(apart).tolist(), np.flatnonzero(~apart)
        chunk = np.cumsum(sizes[usual]) // CHUNK
        groups = np.split(usual, np.flatnonzero(np.diff(chunk)) + 1) if len(usual) else []
        wholes = ["".join(map(parts.__getitem__, group.tolist())) for group in groups]
        numbers = [np.zeros(len(parts), np.int64) for _ in range(2)]
        valid = np.zeros(len(parts), bool)
        ids = [[np.empty(0, np.int32)], [np.empty(0, np.int32)]]
        order = []  # parts in the order of their ids

        def split(group, found):
            """Take the ids over if both sides have a cut at the end of every part."""
            ends = np.cumsum(bytes_[group])
            arrays, cuts = [], []
            for tokens, lengths in zip(found, (self.a_sizes, self.b_sizes), strict=True):
                arrays.append(np.array(tokens, np.int32))
                reach = np.cumsum(lengths[arrays[-1]])
                cuts.append(np.searchsorted(reach, ends) + 1)
                if not np.array_equal(reach[cuts[-1] - 1], ends):
                    return False
            for side in range(2):
                numbers[side][group] = np.diff(cuts[side], prepend=0)
                ids[side].append(arrays[side])
            order.append(group)
            valid[group] = True
            return True

        for group, whole, *found in zip(groups, wholes, *self._both(wholes), strict=True):
            if not (self._fits(whole, *found) and split(group, found)):
                alone += group.tolist()
        texts = [parts[i] for i in alone]
        for i, whole, *found in zip(alone, texts, *self._both(texts), strict=True):
            if self._fits(whole, *found):
                split([i], found)
        order = np.concatenate(order) if order else np.empty(0, np.int64)
        sorted_ = (np.diff(order) > 0).all()
        flat = []
        for own, n in zip(map(np.concatenate, ids), numbers, strict=True):
            flat.append(own if sorted_ else own[np.argsort(np.repeat(order, n[order]), kind="stable")])
        return flat[0], numbers[0], flat[1], numbers[1], valid


class Aligned:
    """Groups and links of parts, in one byte order.

    Arrays over links: ``a`` and ``b`` (ids) and ``part``; over parts: ``n_a``, ``n_b``,
    ``n_groups``, ``n_links`` and ``valid``.
    """

    def __init__(self, spans, parts):
        self.a_ids, self.n_a, self.b_ids, self.n_b, self.valid = spans.encode(parts)
        a_ends, b_ends = np.cumsum(spans.a_sizes[self.a_ids]), np.cumsum(spans.b_sizes[self.b_ids])
        self.a_part, self.b_part = (np.repeat(np.arange(len(parts)), n) for n in (self.n_a, self.n_b))
        # Between two neighbouring ends lies one token of A and one of B: a link.
        ends = np.concatenate([a_ends, b_ends])
        ends.sort(kind="stable")  # merges the two
        twice = np.zeros(len(ends), bool)
        twice[1:] = ends[1:] == ends[:-1]
        common, ends = ends[twice], ends[~twice]
        a_at, b_at = np.searchsorted(a_ends, ends), np.searchsorted(b_ends, ends)
        self.a, self.b, self.part = self.a_ids[a_at], self.b_ids[b_at], self.a_part[a_at]
        self.n_links = np.bincount(self.part, minlength=len(parts))
        self.a_group, self.b_group = np.searchsorted(common, a_ends), np.searchsorted(common, b_ends)
        self.n_groups = np.bincount(self.a_part[np.searchsorted(a_ends, common)], minlength=len(parts))

    def keys(self):
        return (self.a.astype(np.uint64) << np.uint64(32)) | self.b.astype(np.uint64)

    def notations(self):
        """``a1,a2|b1;a3|b2,b3`` of every part."""
        order = np.argsort(np.concatenate([2 * self.a_group, 2 * self.b_group + 1]), kind="stable")
        if not len(order):
            return [""] * len(self.valid)
        ids = np.concatenate([self.a_ids, self.b_ids])[order]
        part = np.concatenate([self.a_part, self.b_part])[order]
        group = np.concatenate([self.a_group, self.b_group])[order]
        side = np.repeat([0, 1], [len(self.a_ids), len(self.b_ids)])[order]
        kind = np.zeros(len(ids), int)
        kind[:-1] = np.where(group[1:] != group[:-1], 2, side[1:] != side[:-1])
        kind[:-1][part[1:] != part[:-1]] = 3
        marks = np.array([",", "|", ";", "\n"], object)[kind]
        marks[-1] = ""
        mixed = [None] * (2 * len(ids))
        mixed[::2], mixed[1::2] = map(str, ids.tolist()), marks.tolist()
        found = iter("".join(mixed).split("\n"))
        return [next(found) if n else "" for n in self.n_a]
