"""Ranked search, tokenizer alignment and exact copies against brute force."""

import collections
import hashlib
import random
import re

import numpy as np
import pytest

import public_tokenizers
from footfall.llm import block_names, pair_counts, perfect_hash, ranked_search, token_spans
from tests.llm.conftest import CASES

PATHS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
ROWS = [(c[0], c[1] or "") for c in CASES]


def same(got, expected):
    assert sorted(map(repr, got)) == sorted(map(repr, expected))


# --- exact copies --------------------------------------------------------------------


def brute_copies(rows):
    """doc_id, keep_id, group_size, text_sha256, and how many rows of each text stay."""
    groups = collections.defaultdict(list)
    for doc_id, text in rows:
        groups[text or ""].append(doc_id)
    out = []
    for text, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        out += [(i, keep, len(ids), hashlib.sha256(text.encode()).hexdigest()) for i in ids]
    return out


def check_copies(df, rows):
    got = df.collect()
    same([(r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got], brute_copies(rows))
    stays = [(r.text_sha256, r.doc_id == r.keep_id) for r in got if r.kept]
    same(stays, [(hashlib.sha256(t.encode()).hexdigest(), True) for t in {t or "" for _, t in rows}])


@pytest.mark.parametrize("block", [1, 3, 1024])
def test_copies_of_the_cases(docs, none, block):
    check_copies(block_names.exact_duplicates(docs, block=block), [c[:2] for c in CASES])
    assert block_names.exact_duplicates(none, block=block).count() == 0


def test_texts_that_share_blocks_but_differ(spark):
    rng = random.Random(3)
    rows = []
    for i in range(600):  # long texts of few different blocks; lengths around whole blocks
        rows.append((i, "".join(rng.choice("ab") for _ in range(rng.choice([0, 1, 2, 3, 4, 5, 7, 8, 9])))))
    rows += [(1000 + i, "ab" * 40 + ("c" if i % 3 == 0 else "") + "ab" * 40) for i in range(200)]  # a hot block
    rows += [(2000, "é" * 10), (2001, "é" * 10), (2002, "é" * 9), (None, "x"), (None, "x"), (None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    check_copies(block_names.exact_duplicates(df, block=2), rows)


def test_blocks_of_one_bucket_keep_apart(spark, monkeypatch):
    """With four buckets the ranks alone tell blocks apart, on both ways to a name."""
    monkeypatch.setattr(block_names, "BUCKET_BITS", 2)
    monkeypatch.setattr(block_names, "FEW", 100)
    rows = [(i, f"{i % 40:05d}{i % 3}") for i in range(300)]
    check_copies(block_names.exact_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), block=2), rows)
    monkeypatch.setattr(block_names, "FEW", 1000)
    check_copies(block_names.exact_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), block=2), rows)


def test_a_text_of_megabytes(spark):
    text = "0123456789abcdef" * 200_000
    rows = [(1, text), (2, text), (3, text[:-1]), (4, "z" + text[1:]), (5, text[:-1] + "é")]
    check_copies(block_names.exact_duplicates(spark.createDataFrame(rows, "doc_id long, text string")), rows)


# --- ranked search -------------------------------------------------------------------

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def brute_terms(text):
    return [re.sub("[A-Z]", lambda m: m[0].lower(), t) for t in TERM.findall(text or "")]


def brute_search(docs, items, k):
    counted = [(d, collections.Counter(brute_terms(t))) for d, t in docs]
    counted = [(d, c) for d, c in counted if c]
    n_docs, n_terms = len(counted), sum(sum(c.values()) for _, c in counted)
    df = collections.Counter(t for _, c in counted for t in c)
    out = []
    for item_id, text in items:
        scored = []
        for d, c in counted:
            n = sum(c.values())
            m = 50 + 50 * n * n_docs // n_terms
            score = sum(
                ranked_search.weight(n_docs, df[t]) * (10**9 * c[t] // (1000 * c[t] + 20 * m))
                for t in set(brute_terms(text)) if t in c
            )
            if score > 0:
                scored.append((-score, d is None, d or 0, d))
        out += [(item_id, r, d, -s) for r, (s, _, _, d) in enumerate(sorted(scored)[:k], 1)]
    return out


def corpus(seed, n, vocabulary=60):
    rng = np.random.default_rng(seed)
    word = lambda: f"w{min(int(rng.zipf(1.3)), vocabulary)}"
    return [(i, " ".join(word() for _ in range(int(rng.integers(1, 40))))) for i in range(n)]


@pytest.mark.parametrize("shard, k, first, most", [(2_000_000, 50, 256, 1_000_000), (300, 3, 1, 5), (1, 5, 2, 40)])
def test_search_equals_scoring_all(spark, monkeypatch, shard, k, first, most):
    docs = corpus(1, 400) + [(i, "w1 w2") for i in range(500, 560)] + [(None, "w1 w2"), (700, None), (701, ""), (701, "w9 w9")]
    items = [(i, t) for i, t in corpus(2, 12)] + [(3, "w1 w2"), (20, None), (21, "absent"), (None, "W7 w8!")]
    monkeypatch.setattr(ranked_search.resolve, "__defaults__", (first,))
    found = ranked_search.search(
        spark.createDataFrame(docs, "doc_id long, text string").repartition(3),
        spark.createDataFrame(items, "item_id long, text string"), k=k, most=most, shard=shard,
    )
    same([tuple(r) for r in found.collect()], brute_search(docs, items, k))


def test_search_takes_the_cases(docs, none, spark):
    items = docs.selectExpr("doc_id AS item_id", "text", "1 AS rank", "2 AS score")
    rows = [c[:2] for c in CASES]
    got = [tuple(r) for r in ranked_search.search(docs, items).collect()]
    same(got, brute_search(rows, rows, 50))
    assert ranked_search.search(none, items).count() == 0
    assert ranked_search.search(docs, items.limit(0)).columns == ["item_id", "rank", "doc_id", "score"]


def test_intervals_stop_before_the_ends_of_lists():
    """A document far ahead is found without reading a long list to its end."""

    class Watched(np.ndarray):
        most = 0

        def __getitem__(self, i):
            if isinstance(i, slice):
                Watched.most = max(Watched.most, i.stop)
            return np.asarray(self)[i]

    n = 100_000
    order = np.arange(n)
    lists = [(order.view(Watched), np.arange(n, 0, -1)), (np.array([0]), np.array([10**6]))]
    found, scores = ranked_search.resolve(lists, n, 1)
    assert found.tolist() == [0] and scores.tolist() == [10**6 + n] and Watched.most < n // 10


# --- tokenizer alignment --------------------------------------------------------------


def tokens_of(text):
    """Ids and bytes of both tokenizers, each applied to the whole text."""
    import sentencepiece
    from tokenizers import Tokenizer

    if not hasattr(tokens_of, "made"):
        a = Tokenizer.from_file(PATHS[0])
        a.encode_special_tokens = True
        tokens_of.made = a, sentencepiece.SentencePieceProcessor(model_file=PATHS[1])
    a, b = tokens_of.made
    byte = token_spans._byte_characters()
    ids_a = a.encode(" " + text, add_special_tokens=False).ids
    ids_b = b.encode(text)
    raw_a = [bytes(byte[c] for c in a.id_to_token(i)) for i in ids_a]
    pieces = [b.id_to_piece(i) for i in ids_b]
    raw_b = [
        bytes([int(p[3:5], 16)]) if re.fullmatch("<0x[0-9A-F]{2}>", p) else p.replace("▁", " ").encode() for p in pieces
    ]
    whole = (" " + text).encode()
    if not text or b"".join(raw_a) != whole or b"".join(raw_b) != whole:
        return [], []
    return [list(zip(i, map(len, r), strict=True)) for i, r in ((ids_a, raw_a), (ids_b, raw_b))]


def brute_alignment(rows):
    spans = []
    for _, text in rows:
        sides = []
        for tokens in tokens_of(text or ""):
            at, own = 0, []
            for i, size in tokens:
                own.append((i, at, at + size))
                at += size
            sides.append(own)
        links = []
        j = 0
        for a, a0, a1 in sides[0]:
            while j and sides[1][j][1] > a0:
                j -= 1
            while j < len(sides[1]) and sides[1][j][1] < a1:
                if sides[1][j][2] > a0:
                    links.append((a, sides[1][j][0]))
                j += 1
            j = max(0, j - 1)
        spans.append((sides, links))
    counts = collections.Counter(x for _, links in spans for x in links)
    best = collections.defaultdict(int)
    for (_, b), n in counts.items():
        best[b] = max(best[b], n)
    out = []
    for (doc_id, _), ((a, b), links) in zip(rows, spans, strict=True):
        ends = sorted({x[2] for x in a} & {x[2] for x in b})
        groups = []
        for low, high in zip([0, *ends], ends, strict=False):
            own = [",".join(str(x[0]) for x in side if low < x[2] <= high) for side in (a, b)]
            groups.append("|".join(own))
        digest = hashlib.sha256(";".join(groups).encode()).hexdigest() if a else ""
        out.append((
            doc_id, len(a), len(b), len(groups), len(links),
            sum(counts[x] == best[x[1]] for x in links), sum(counts[x] for x in links), digest,
        ))
    return out


def odd_texts(seed, n):
    rng = random.Random(seed)
    bits = [
        " ", "  ", "\n", "\n\n", "\t", "\r\n", "\r", "\x0b", "\x1c", "\x1f", "\x85", " ", " ", "　", " ", "\x00",
        "word", "Word", "don't", "'s", "123", "!!", "...", ";", "{", "}", "();", "é", "é", "日本語", "🙂", "▁", "<0x41>", "<s>", "</s>",
        "<unk>", "<|endoftext|>", "﻿", "​", "-", "_", "__", "a", "I", "(", ")", "¿Qué?",
    ]
    return ["".join(rng.choice(bits) for _ in range(rng.randint(1, 14))) for _ in range(n)]


def test_parts_are_encoded_like_whole_texts():
    texts = [t for t in odd_texts(5, 6000)]
    spans = token_spans.Spans.of(*PATHS)
    parts = [token_spans.stretches(t) for t in texts]
    assert all("".join(p) == " " + t for p, t in zip(parts, texts, strict=True))
    different = list(dict.fromkeys(p for own in parts for p in own))
    a, n_a, b, n_b, valid = spans.encode(different)
    a, b = (dict(zip(different, np.split(x, np.cumsum(n)[:-1]), strict=True)) for x, n in ((a, n_a), (b, n_b)))
    good = dict(zip(different, valid, strict=True))
    for text, own in zip(texts, parts, strict=True):
        expected = [[i for i, _ in side] for side in tokens_of(text)]
        if not all(good[p] for p in own):
            assert expected == [[], []], repr(text)
        else:
            assert [i for p in own for i in a[p]] == expected[0], repr(text)
            assert [i for p in own for i in b[p]] == expected[1], repr(text)


def test_stretches_are_those_of_the_pattern():
    pattern = re.compile("[ \n]+[^ \n]+|[ \n]+$")
    rng = np.random.default_rng(12)
    for n in rng.integers(1, 12, 3000):
        text = "".join(rng.choice(list(" \nab\0é"), n))
        assert token_spans.stretches(text) == pattern.findall(" " + text), repr(text)
    for c in map(chr, range(0x110000)):
        if c.isspace() and c not in " \n":
            assert token_spans.stretches(f"a{c}b c{c} d") == [f" a{c}b", f" c{c} d"], repr(c)


def test_alignment_of_the_cases(docs, none):
    rows = [tuple(r) for r in pair_counts.align(docs, *PATHS).collect()]
    same(rows, brute_alignment([c[:2] for c in CASES]))
    assert pair_counts.align(none, *PATHS).count() == 0


@pytest.mark.parametrize("block_pairs, per_round, known", [(1 << 16, 64, 300_000), (50, 2, 100)])
def test_alignment_in_rounds(spark, monkeypatch, block_pairs, per_round, known):
    monkeypatch.setattr(pair_counts, "KNOWN", known)
    texts = odd_texts(6, 150) + [CASES[0][1], CASES[8][1], CASES[8][1], None, ""]
    rows = list(enumerate(texts))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(40)
    found = pair_counts.align(df, *PATHS, block_pairs=block_pairs, per_round=per_round)
    same([tuple(r) for r in found.collect()], brute_alignment(rows))


def test_hash_is_minimal_perfect_and_verified():
    rng = np.random.default_rng(4)
    for n in (1, 2, 100, 70_000):
        keys = np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64))
        made, ordered = perfect_hash.build(keys)
        block = perfect_hash.Block(made, ordered)
        assert sorted(block.verified(keys).tolist()) == list(range(len(keys)))
        assert (ordered[block.verified(keys)] == keys).all()
        others = np.setdiff1d(rng.integers(0, 1 << 63, 1000).astype(np.uint64), keys)
        assert (block.verified(others) == -1).all()
        assert sum(map(len, made)) * 8 < 5 * len(keys) + 200  # bits a key
