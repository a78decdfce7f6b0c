"""Byte-level BPE run by a sentencepiece model built from the vocabulary alone.

Each token's bytes become a string of printable characters, one for each byte, and a
piece whose score is its negative rank, so the merges are those of the ranks. The model
normalises nothing. A text is cut into pre-tokens by the vocabulary's pattern; a
pre-token that is a token is that token, any other goes through the model. Decoding maps
each id back to its bytes.

Parts between spaces are kept in a table of bounded size (see ``pieces_table``).

Defined results: a null text is empty and has no ids; repeated rows are encoded each; an
empty table gives an empty table; other columns pass through unless they have the name
of a result, which is replaced.
"""

import base64
import re
import struct

import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import small_batches, whole_text
from .pieces_table import PartTable, list_array, portions


def byte_characters():
    """A printable character for each byte: itself where printable, else from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    table = {b: chr(b) for b in plain}
    for b in range(256):
        if b not in table:
            table[b] = chr(0x100 + len(table) - len(plain))
    return [table[b] for b in range(256)]


def read_ranks(path):
    """Ranks by token bytes, from lines of base64 and rank."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


def _varint(n):
    out = b""
    while n > 0x7F:
        out += bytes([n & 0x7F | 0x80])
        n >>= 7
    return out + bytes([n])


def _field(number, kind, payload):
    head = _varint(number << 3 | kind)
    return head + (_varint(len(payload)) + payload if kind == 2 else payload)


def serialise(ranks):
    """A sentencepiece BPE model of the ranks; piece ids are ranks, the unknown piece comes last.

    Fields of the public model format: pieces 1 (piece 1, score 2, type 3), trainer 2
    (type 3, vocabulary size 4, ids 40 to 43), normaliser 3 (name 1, prefix 3, spaces 4 and 5).
    """
    characters = byte_characters()
    pieces = sorted((rank, "".join(characters[b] for b in token)) for token, rank in ranks.items())
    if [rank for rank, _ in pieces] != list(range(len(pieces))):
        raise ValueError("ranks must count from 0")
    minus_one = _varint((1 << 64) - 1)
    body = b"".join(
        _field(1, 2, _field(1, 2, piece.encode()) + _field(2, 5, struct.pack("<f", -rank)))
        for rank, piece in pieces
    )
    unknown = _field(1, 2, b"<unk>") + _field(2, 5, struct.pack("<f", 0)) + _field(3, 0, _varint(2))
    trainer = (
        _field(3, 0, _varint(2))
        + _field(4, 0, _varint(len(pieces) + 1))
        + _field(40, 0, _varint(len(pieces)))
        + b"".join(_field(n, 0, minus_one) for n in (41, 42, 43))
    )
    normaliser = _field(1, 2, b"identity") + b"".join(_field(n, 0, _varint(0)) for n in (3, 4, 5))
    return body + _field(1, 2, unknown) + _field(2, 2, trainer) + _field(3, 2, normaliser)


class Coder:
    """Encoder of one vocabulary; built once per Python worker and path."""

    made = {}

    def __init__(self, path, pattern):
        import regex
        import sentencepiece

        ranks = read_ranks(path)
        self.ranks = {token.decode("latin-1"): rank for token, rank in ranks.items()}
        self.bytes = sorted(ranks, key=ranks.get).__getitem__
        self.split = regex.compile(pattern).findall
        self.table = {i: c for i, c in enumerate(byte_characters())}
        self.model = sentencepiece.SentencePieceProcessor(model_proto=serialise(ranks))
        self.pretokens = PartTable(self._pretokens)
        self.parts = PartTable(self._parts)

    @classmethod
    def of(cls, path, pattern):
        key = (path, pattern)
        if key not in cls.made:
            cls.made[key] = cls(path, pattern)
        return cls.made[key]

    def _pretokens(self, pretokens):
        """Ids of pre-tokens: of a token itself, or from the model, all others at once."""
        raw = [x.encode().decode("latin-1") for x in pretokens]
        ids = [self.ranks.get(x) for x in raw]
        rest = [x.translate(self.table) for x, i in zip(raw, ids, strict=True) if i is None]
        found = iter(self.model.encode(rest, num_threads=1))
        return [next(found) if i is None else [i] for i in ids]

    def _parts(self, parts):
        cut = []
        for part in parts:
            plain = PLAIN.fullmatch(part)
            cut.append(plain.groups("") if plain else self.split(part))
        known = self.pretokens.bytes(set().union(*cut) - {""})
        return [b"".join([known[x] for x in row if x]) for row in cut]

    def encode(self, texts):
        return self.parts.rows([part(text) for text in texts])


def token_bytes(path):
    """The bytes of each id, in order."""
    return [token for token, _ in sorted(read_ranks(path).items(), key=lambda x: x[1])]


# Two pre-tokens, or one, of any pattern of this family.
PLAIN = re.compile("( ?[A-Za-z\u00C0-\u00D6\u00D8-\u00F6\u00F8-\u00FF]+)([.,]?)")
# A pattern of this family starts a pre-token at a space that stands before a visible
# character, so texts may be cut there. White space after a space is left uncut.
UNSURE = re.compile(r" (?:\s|\Z)")


def part(text):
    """The text in parts that begin at pre-tokens and are together the text."""
    if not text:
        return []
    if UNSURE.search(text):
        return re.split(r"(?<=\S)(?= \S)", text)
    first, *rest = text.split(" ")
    return [first, *[" " + x for x in rest]] if first else [" " + x for x in rest]


def _held(df, value, replaced):
    """``df`` as the value a worker reads and a struct of the columns that pass through."""
    rest = [c for c in df.columns if c.lower() not in [r.lower() for r in replaced]]
    return df.select(value.alias("_value"), F.struct(*[F.col(f"`{c}`") for c in rest]).alias("_row"))


def _made(held, run, **results):
    """The columns that pass through and those of ``run``, with the names of ``results``."""
    fields = [T.StructField(f"_{i}", kind) for i, kind in enumerate(results.values())]
    made = held.mapInArrow(run, T.StructType([T.StructField("_row", held.schema["_row"].dataType), *fields]))
    return made.select("_row.*", *[F.col(f"_{i}").alias(name) for i, name in enumerate(results)])


def _encoded(batches, coder):
    """Rows and the id array of each, some texts at a time."""
    for batch in batches:
        texts = batch.column(0).to_pylist()
        for first, end in portions(texts):
            yield batch.column(1).slice(first, end - first), coder.encode(texts[first:end])


def _decoded(rows, get):
    return pa.array([b"".join(map(get, row.tolist())) for row in rows], pa.binary())


IDS = T.ArrayType(T.IntegerType())


def encode(docs, path, pattern, text="text", ids="ids"):
    """``docs`` with the array of token ids of each whole text."""
    small_batches(docs.sparkSession)

    def run(batches):
        for rows, found in _encoded(batches, Coder.of(path, pattern)):
            yield pa.record_batch([rows, list_array(found)], ["_row", "_0"])

    return _made(_held(docs, whole_text(f"`{text}`"), [ids]), run, **{ids: IDS})


def decode(tokens, path, ids="ids", raw="raw"):
    """``tokens`` with the bytes of each array of ids."""
    small_batches(tokens.sparkSession)

    def run(batches):
        get = token_bytes(path).__getitem__
        for batch in batches:
            found = _decoded([x.values.to_numpy() for x in batch.column(0)], get)
            yield pa.record_batch([batch.column(1), found], ["_row", "_0"])

    given = F.coalesce(F.col(f"`{ids}`"), F.array().cast("array<int>"))
    return _made(_held(tokens, given, [raw]), run, **{raw: T.BinaryType()})


def round_trip(docs, path, pattern, text="text", ids="ids", raw="raw"):
    """``docs`` with the ids of each whole text and the bytes that those decode to.

    The same as ``decode`` of ``encode``, which would keep two Python workers a task.
    """
    small_batches(docs.sparkSession)

    def run(batches):
        coder = Coder.of(path, pattern)
        for rows, found in _encoded(batches, coder):
            yield pa.record_batch([rows, list_array(found), _decoded(found, coder.bytes)], ["_row", "_0", "_1"])

    return _made(_held(docs, whole_text(f"`{text}`"), [ids, raw]), run, **{ids: IDS, raw: T.BinaryType()})
