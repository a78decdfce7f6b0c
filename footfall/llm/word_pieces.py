"""Token ids by a tokenizer file of the tokenizers library, part by part.

Normalisation and pre-tokenisation of the vocabulary used here never reach across a
space or a line feed. A stretch of plain characters only is put in lower case as a whole,
which is all that normalising does to it, and cut like the pre-tokeniser cuts; each
different piece of that is encoded once, many at a time. Texts with other characters are
taken part by part between spaces and line feeds, and parts that are not plain go through
the whole tokenizer. Strings of special tokens are special tokens, as the library has it.
"""

import os
import re
from array import array

import numpy as np

from .pieces_table import PartTable

# Printable ASCII and Latin letters that are composed and whose lower case is one letter.
PLAIN = re.compile("[\n -~\u00C0-\u00D6\u00D8-\u00F6\u00F8-\u00FF]*")
SPECIAL = "<|"  # begins the special tokens
# The pre-tokens of plain texts in lower case.
PIECES = re.compile(
    "[a-z\u00DF-\u00F6\u00F8-\u00FF]+|'(?:s|t|re|ve|m|ll|d)|[0-9]|[^\\sa-z0-9\u00DF-\u00F6\u00F8-\u00FF]+"
)
END = "</w>"


def plain(text):
    return SPECIAL not in text and PLAIN.fullmatch(text) is not None


class Words:
    """Encoder of one file; built once per Python worker and path."""

    made = {}

    def __init__(self, path):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.plain = Tokenizer(self.tokenizer.model)
        self.plain.pre_tokenizer = pre_tokenizers.Sequence(
            [
                pre_tokenizers.WhitespaceSplit(),
                pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False),
            ]
        )
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith(END)]] = True
        self.runs = PartTable(self._runs)
        self.parts = PartTable(self._parts)

    @classmethod
    def of(cls, path):
        if path not in cls.made:
            cls.made[path] = cls(path)
        return cls.made[path]

    def _whole(self, parts):
        return [x.ids for x in self.tokenizer.encode_batch_fast(parts, add_special_tokens=False)]

    def _runs(self, runs):
        """Ids of pre-tokens; the last id of each is that of an ending piece."""
        ids = self.plain.encode_batch_fast([" ".join(runs)], add_special_tokens=False)[0].ids
        cuts = np.flatnonzero(self.ends[ids]) + 1
        if len(cuts) != len(runs):
            return self._whole(runs)
        return [ids[a:b] for a, b in zip([0, *cuts[:-1].tolist()], cuts.tolist(), strict=True)]

    def _parts(self, parts):
        """Ids of parts of texts that are not plain."""
        is_plain = list(map(plain, parts))
        rest = iter(self._whole([p for p, x in zip(parts, is_plain, strict=True) if not x]))
        pieces = [PIECES.findall(p.lower()) if x else [] for p, x in zip(parts, is_plain, strict=True)]
        get = self.runs.bytes(set().union(*pieces)).__getitem__
        return [
            b"".join(map(get, own)) if x else array("i", next(rest)).tobytes()
            for own, x in zip(pieces, is_plain, strict=True)
        ]

    def encode(self, texts):
        """An id array for each text."""
        pieces = [PIECES.findall(text.lower()) if plain(text) else None for text in texts]
        other = [text.replace("\n", " ").split(" ") for text, own in zip(texts, pieces, strict=True) if own is None]
        found = iter(self.parts.rows(other) if other else ())
        ready = iter(self.runs.rows([own for own in pieces if own is not None]))
        return [next(found) if own is None else next(ready) for own in pieces]
