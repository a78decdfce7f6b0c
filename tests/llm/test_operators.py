"""Each dealt operator against a brute-force version on the cases."""

import collections
import re
import unicodedata
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import public_tokenizers
from footfall.llm import (
    byte_pieces,
    direct_codes,
    divergence,
    hyperlang,
    packing,
    permutations,
    rule_ensemble,
    secrets,
    simhash,
    word_lengths,
    word_pieces,
)
from tests.llm.conftest import CASES

TEXTS = [(c[0], c[1] or "") for c in CASES]
WORD = re.compile(r"[^\x20\x09-\x0D]+")
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
LATIN = public_tokenizers.path("byte_bpe_50k.tiktoken")


def same(got, expected):
    assert sorted(map(repr, got)) == sorted(map(repr, expected))


# --- quality rules ---------------------------------------------------------------


def measured(text):
    words = WORD.findall(text)
    windows = collections.Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    repeated = {
        k
        for i in range(len(words) - 4)
        if windows[tuple(words[i : i + 5])] > 1
        for k in range(i, i + 5)
    }
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (
        len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)),
        len(lines) - len(set(lines)), len(repeated),
    )


def test_quality_measures(docs):
    got = divergence.judge(docs)
    assert set(got.columns) == set(docs.columns)
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    same(
        [tuple(r) for r in got.select("doc_id", *[f"verdict.{n}" for n in names]).collect()],
        [(d, *measured(t)) for d, t in TEXTS],
    )


def test_quality_verdict_follows_the_distance(spark):
    plain = [(i, "the cat and the dog sat on a mat with it " * 12 + f"w{i}", "en") for i in range(30)]
    plain = [(i, " ".join(w + str(k // 11) for k, w in enumerate(t.split())), l) for i, t, l in plain]
    plain = [(i, re.sub(r"(the|and|on|a)\d+", r"\1", t), l) for i, t, l in plain]
    loud = [(99, " ".join(f"LOUD{k}!!" for k in range(150)), "en")]
    rows = spark.createDataFrame(plain + loud + [(100, loud[0][1], None)], "doc_id long, text string, lang string")
    got = dict(divergence.judge(rows).select("doc_id", "verdict.kept").collect())
    assert not got[99] and all(got[i] for i in range(30))
    assert got[100]  # without a language, the base rules alone


def test_every_language_has_a_reference_of_all_its_words(spark, monkeypatch):
    """More languages than fit a broadcast, and common words of any length."""
    monkeypatch.setattr(divergence, "REFERENCE_WORDS", 100)
    rows = []
    for k in range(270):
        own = [f"{chr(97 + k % 26) * 9}{chr(97 + k // 26)}{i}" for i in range(20)]
        rows += [(2 * k, " ".join(own[i % 20 if i % 2 else 0] + str(i // 40) for i in range(120)), f"l{k}")]
        rows += [(2 * k + 1, rows[-1][1][::-1], f"l{k}")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(5)
    refs = {r.ref_lang: r for r in divergence.references(df).collect()}
    assert len(refs) == 270
    counts = collections.Counter(w for r in rows if r[2] == "l7" for w in r[1].split())
    assert [round(x * 240) for x in refs["l7"].ref_shares[:24]] == sorted(counts.values(), reverse=True)[:24]
    fields = "doc_id", "verdict.kept", "verdict.word_js", "verdict.class_js"
    whole = sorted(map(tuple, divergence.judge(df).select(*fields).collect()))
    assert all(r[2] is not None for r in whole)
    monkeypatch.setattr(divergence, "MOST_BROADCAST", 7)
    assert sorted(map(tuple, divergence.judge(df).select(*fields).collect())) == whole


@pytest.mark.parametrize("p, q, expected", [([1.0, 0.0], [0.0, 1.0], 1.0), ([0.5, 0.5], [0.5, 0.5], 0.0)])
def test_distance(spark, p, q, expected):
    found = spark.range(1).select(divergence.distance(F.lit(p), F.lit(q)).alias("d")).first()[0]
    assert found == pytest.approx(expected)


# --- secrets ---------------------------------------------------------------------


def base_spans(text):
    found = []
    for kind, pattern, group, least in (
        ("assign", r"(?ai:(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+))", 2, 6),
        ("access", r"AKIA[A-Z0-9]+", 0, 20),
        ("hex", r"[0-9a-f]+", 0, 24),
    ):
        for m in re.finditer(pattern, text):
            if len(m[group]) >= least:
                found.append((m.start(), ["assign", "access", "hex"].index(kind), kind, m.end()))
    return ",".join(f"{k}:{a}:{b}" for a, _, k, b in sorted(found))


def test_base_spans(docs):
    got = secrets.find(docs).select("doc_id", secrets.notation("spans").alias("s")).collect()
    same([tuple(r) for r in got], [(d, base_spans(t)) for d, t in TEXTS])


def test_ownership_separates_examples_from_credentials(spark):
    live, copied = "Zk3vQ9xLm2Rt7Yp4Wn8Bs6Hd", "Qp7Lr2Xc9Vb4Nm6Ks1Wd8Tf3Gh"
    rows = [(1, f"key {live} end", "a"), (2, f"see {live}", "a")]
    rows += [(10 + i, f"😀 see {copied} now token: short", f"s{i}") for i in range(5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = {r.doc_id: r.s for r in secrets.find(docs).select("doc_id", secrets.notation("spans").alias("s")).collect()}
    assert got[1] == "opaque:4:28" and got[2] == "opaque:4:28"
    assert all(got[10 + i] == "" for i in range(5))


def test_repositories_decide_beside_owners(spark):
    few, many = "Zk3vQ9xLm2Rt7Yp4Wn8Bs6Hd", "Qp7Lr2Xc9Vb4Nm6Ks1Wd8Tf3Gh"
    rows = [(1, few, "a", "r"), (2, few, "b", "r")]  # a credential and a copy of its document
    rows += [(10 + i, many, "a", f"r{i}") for i in range(secrets.COPIED_REPOS)]
    rows += [(1000 + i, few[::-1], "a", "one") for i in range(secrets.COPIED_REPOS)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, repo string")
    found = secrets.find(docs, repo="repo").select("doc_id", F.size("spans").alias("n")).collect()
    assert all(r.n == (0 if 10 <= r.doc_id < 1000 else 1) for r in found) and len(found) == len(rows)


def test_redaction_masks_overlapping_spans(spark):
    docs = spark.createDataFrame(
        [(1, "é token=0123456789abcdef0123456789abcdef!", "a")], "doc_id long, text string, source string"
    )
    found = secrets.find(docs, ids=("doc_id", "text"))
    assert found.select(secrets.redact(F.col("text"), F.col("spans"))).first()[0] == "é [SECRET]!"


# --- byte BPE --------------------------------------------------------------------


def test_byte_pieces_equal_tiktoken(docs):
    import tiktoken

    ranks = byte_pieces.read_ranks(RANKS)
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    tokens = byte_pieces.encode(docs, RANKS, public_tokenizers.PATTERN)
    assert sorted(tokens.columns) == sorted(docs.columns)
    back = byte_pieces.decode(tokens, RANKS)
    got = [(r.doc_id, list(r.ids), bytes(r.raw)) for r in back.select("doc_id", "ids", "raw").collect()]
    same(got, [(d, own.encode_ordinary(t), t.encode()) for d, t in TEXTS])


def test_round_trip_is_decode_of_encode_in_one_worker(docs):
    both = byte_pieces.round_trip(docs, RANKS, public_tokenizers.PATTERN)
    apart = byte_pieces.decode(byte_pieces.encode(docs, RANKS, public_tokenizers.PATTERN), RANKS)
    assert both.schema["ids"].dataType == apart.schema["ids"].dataType
    assert sorted(both.columns) == sorted(apart.columns)
    same(both.select(*apart.columns).collect(), apart.collect())
    assert both._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1


def test_parts_are_the_text():
    for text in ["", " ", "a", " a b", "a  b", "a \nb c", "a 　b", "  ", "a b ", "x\t y"]:
        assert "".join(byte_pieces.part(text)) == text


# --- token files -----------------------------------------------------------------


def test_token_files(spark, docs, tmp_path):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    own = Tokenizer.from_file(path)
    direct_codes.write(docs, str(tmp_path / "t"), path)
    got = [tuple(r) for r in direct_codes.read(spark, str(tmp_path / "t")).orderBy("start").collect()]
    start, expected = 0, []
    for d, t in sorted(TEXTS, key=lambda x: (x[0] is not None, x[0] or 0)):
        ids = [*own.encode(t, add_special_tokens=False).ids, 1]
        expected.append((d, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert got == expected


def test_token_ids_of_odd_texts_are_those_of_the_library():
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    own, words = Tokenizer.from_file(path), word_pieces.Words.of(path)
    plain = ["word", "Don't", "'S", " ", "  ", "\n", "123", "!!", "a1b2", "É", "ß", "(", "<", "|>", "-", "_"]
    odd = ["<|endoftext|>", "<|startoftext|>", "é", "ẞ", "İ", "ſ", "×", "日本語", "🙂", "\t", "\x1c", "\x85", "\u2003", "\x00", "½"]
    rng = np.random.default_rng(2)
    texts = ["".join(rng.choice(plain + odd * (i % 2), rng.integers(0, 14))) for i in range(4000)]
    texts += ["a <|endoftext|> b", "x" * 100_000, "ab1 " * 50_000]
    for text, ids in zip(texts, words.encode(texts), strict=True):
        assert ids.tolist() == own.encode(text, add_special_tokens=False).ids, repr(text)


def test_any_token_is_read_directly():
    ids = np.random.default_rng(0).choice([3, 255, 256, 65_535, 65_536, 2**32 - 1, 70], 5000).astype(np.uint32)
    segment = direct_codes.Segment(direct_codes.pack([1, None, 5], [2000, 0, 3000], ids))
    assert (segment.ids() == ids).all() and segment.doc_ids == [1, None, 5]
    assert [segment.at(i) for i in range(0, 5000, 13)] == ids[::13].tolist()


# --- SimHash ---------------------------------------------------------------------


def brute_fingerprint(text):
    from xxhash import xxh64_intdigest

    words = [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in WORD.findall(text)]
    shingles = [" ".join(words[i : i + 4]) for i in range(len(words) - 3)] or ([" ".join(words)] if words else [])
    hashes = [xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprints_and_components(docs):
    got = [tuple(r) for r in simhash.near_duplicates(docs).collect()]
    prints = {t: brute_fingerprint(t) for _, t in TEXTS}
    expected = []
    for d, t in TEXTS:
        near = [x for x, u in TEXTS if bin(prints[t] ^ prints[u]).count("1") <= 4 and x is not None]
        expected.append((d, f"{prints[t]:016x}", min(near, default=None)))
    same(got, expected)


@pytest.mark.parametrize("crowd", [3, 10, 4096])
def test_links_connect_as_all_pairs_do(spark, crowd):
    rng = np.random.default_rng(5)
    centre = rng.integers(0, 1 << 63, 4, np.uint64)
    prints = {int(x) for x in rng.integers(0, 1 << 63, 60, np.uint64)}
    for c in centre:
        for _ in range(40):
            prints.add(int(c) ^ sum(1 << int(b) for b in rng.choice(64, rng.integers(0, 6), replace=False)))
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    root = {p: p for p in signed}

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in signed:
        for b in signed:
            if bin((a ^ b) & (1 << 64) - 1).count("1") <= 4:
                low, high = sorted((top(a), top(b)))
                root[high] = low
    from footfall.llm.links import components

    made = components(simhash.links(spark.createDataFrame([(p,) for p in signed], "fp long"), crowd=crowd))
    got = {p: p for p in signed} | {r.node: r.root for r in made.collect()}
    assert got == {p: top(p) for p in signed}


# --- classifier, languages --------------------------------------------------------


def test_rules_find_the_labels(spark):
    rng = np.random.default_rng(1)
    rows = []
    for i in range(400):
        bad = i % 4 == 0
        words = [f"w{rng.integers(900)}" + ("!!" if bad else "") for _ in range(60)]
        rows.append((i, " ".join(words), int(not bad)))
    table = spark.createDataFrame(rows, "doc_id long, text string, quality int")
    model = rule_ensemble.learn(table, table, F.col("doc_id") % 2 == 0)
    assert 0 < len(model[1]) < 100
    found = rule_ensemble.classify(table, model).collect()
    assert all(r.predicted == r.quality and 0 <= r.score <= 1 for r in found)


def test_compiled_rules_equal_the_model(spark, docs):
    model = (0.1, [(1.5, ((0, 2.0, False), (2, 0.5, True))), (-0.7, ((8, 0.0, False),))])
    got = rule_ensemble.classify(docs, model)
    assert set(got.columns) == {*docs.columns, "predicted"}
    x = rule_ensemble.statistics(docs.select("doc_id", "text")).select(*rule_ensemble.STATISTICS).toPandas().to_numpy()
    margin = model[0] + sum(w * rule_ensemble.holds(r, x) for w, r in model[1])
    assert np.allclose([r.score for r in got.collect()], 1 / (1 + np.exp(-margin)))


def test_statistics_equal_plain_counts(docs):
    def count(kinds, text):
        return sum(c in kinds for c in text)

    def plain(text):
        words, lines = WORD.findall(text), text.split("\n")
        n, chars = max(len(words), 1), sum(map(len, words))
        every = max(len(text), 1)
        pairs = [*zip(words, words[1:]), *[(w, None) for w in words[-1:]]]  # the last word with the end
        return [
            np.log1p(len(words)),
            chars / n,
            len(set(words)) / n,
            len(set(pairs)) / n,
            sum(a == b for a, b in pairs) / n,
            sum(len(w) <= 3 for w in words) / n,
            len(set(lines)) / len(lines) if words else 0,
            len(words) / len(lines),
            sum(unicodedata.category(c) == "Lu" for c in text) / every,
            count("0123456789", text) / every,
            count(".,;:!?'\"()-", text) / every,
            count("#*$%&|<>", text) / every,
            (len(text) - chars) / every,
            text.count("!") / every,
            text.count("|") / every,
        ]

    found = rule_ensemble.statistics(docs.select("doc_id", "text", F.col("text").alias("own"))).collect()
    assert len(found) == len(CASES)
    for row in found:
        assert np.allclose([row[name] for name in rule_ensemble.STATISTICS], plain(row.own or ""), atol=1e-12), row.doc_id


def test_lasso_meets_its_conditions():
    """At the minimum the slope is the penalty where a weight is not zero, and within it elsewhere."""
    rng = np.random.default_rng(5)
    r = (rng.random((600, 12)) < 0.4).astype(float)
    y = (rng.random(600) < 1 / (1 + np.exp(1 - 2 * r[:, 0] + 3 * r[:, 4]))).astype(float)
    intercept, weights = rule_ensemble.lasso(r, y)
    error = 1 / (1 + np.exp(-(intercept + r @ weights))) - y
    slope = r.T @ error / len(y)
    used = weights != 0
    assert used[[0, 4]].all() and not used.all() and abs(error.mean()) < 1e-5
    assert np.allclose(slope[used], -np.sign(weights[used]) * rule_ensemble.PENALTY, atol=1e-5)
    assert (np.abs(slope[~used]) <= rule_ensemble.PENALTY + 1e-5).all()


def test_the_first_cut_is_the_best_of_all():
    rng = np.random.default_rng(7)
    x = rng.integers(0, 12, (300, 3)).astype(float)
    y = ((x[:, 1] > 6) ^ (rng.random(300) < 0.1)).astype(float)
    first = rule_ensemble.extract(x, y)[0][0]
    p = y.mean()

    def gain(f, cut):
        sides = [x[:, f] <= cut, x[:, f] > cut]
        if min(s.sum() for s in sides) < rule_ensemble.LEAF:
            return -np.inf
        return sum((y - p)[s].sum() ** 2 / (p * (1 - p) * s.sum() + 1) for s in sides)

    every = {(f, c): gain(f, c) for f in range(3) for c in np.unique(x[:, f])}
    assert np.isclose(every[first[0], first[1]], max(every.values())) and first[0] == 1


def test_no_labels_give_one_half(docs, none):
    model = rule_ensemble.learn(docs, none.selectExpr("doc_id", "1 AS quality"))
    assert {r.score for r in rule_ensemble.classify(docs, model).collect()} == {0.5}


def test_profiles_are_sums_of_bound_letters():
    own = hyperlang.Profiles()
    found = own.profiles(["Ab, é!", "", "123"])
    letters = [0, *map(ord, "ab"), 0, ord("é"), 0]
    vector = lambda c: own.table[own.letters[c]].astype(int)
    brute = sum(
        np.roll(vector(a), 2) * np.roll(vector(b), 1) * vector(c)
        for a, b, c in zip(letters, letters[1:], letters[2:])
    )
    assert (found[0] == brute).all() and not found[1:].any()


def test_languages(spark, docs):
    texts = {"en": "the thing that they thought of then", "fr": "les eaux et la voix des oiseaux"}
    rows = [(i, texts[k] + f" {i}", k) for i in range(20) for k in texts]
    langs, prototypes = hyperlang.learn(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert langs == ["en", "fr"]
    asked = spark.createDataFrame([(1, "thoughts of the"), (2, "des voix"), (3, None), (4, "12 !")], "doc_id long, text string")
    got = {r.doc_id: r for r in hyperlang.identify(asked, langs, prototypes).collect()}
    assert [got[i].lang_pred for i in (1, 2, 3, 4)] == ["en", "fr", "und", "und"]
    assert got[3].score == 0 and 0 < got[1].score <= 1
    nothing = hyperlang.identify(docs, [], np.zeros((0, hyperlang.SIZE))).collect()
    assert {r.lang_pred for r in nothing} == {"und"} and len(nothing) == len(CASES)


def test_no_language_is_left_out(spark, monkeypatch):
    """More languages than one block holds, equal texts in two of them, and hot ones."""
    monkeypatch.setattr(hyperlang, "BLOCK", 7)
    rng = np.random.default_rng(9)
    texts = ["".join(rng.choice(list("abcdefghijklmnop "), 60)) for _ in range(60)]
    texts[59] = texts[3]
    rows = [(i * 100 + k, t, f"l{i:03}") for i, t in enumerate(texts) for k in range(40 if i == 5 else 2)]
    known = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(5)
    langs, prototypes = hyperlang.learn(known)
    assert langs == [f"l{i:03}" for i in range(60)]
    own = hyperlang.Profiles().profiles(texts).astype(float)
    assert (prototypes == own * np.array([40 if i == 5 else 2 for i in range(60)])[:, None]).all()
    asked = spark.createDataFrame([*enumerate(texts), (70, None), (71, "12")], "doc_id long, text string")
    blocks = {r.doc_id: r for r in hyperlang.identify(asked, langs, prototypes).collect()}
    assert [blocks[i].lang_pred for i in range(60)] == [*langs[:59], "l003"]
    assert all(abs(blocks[i].score - 1) < 1e-9 for i in range(60))
    assert {(blocks[i].lang_pred, blocks[i].score) for i in (70, 71)} == {("und", 0.0)}
    monkeypatch.setattr(hyperlang, "BLOCK", 2048)
    whole = {r.doc_id: r for r in hyperlang.identify(asked, langs, prototypes).collect()}
    assert {i: r.lang_pred for i, r in whole.items()} == {i: r.lang_pred for i, r in blocks.items()}


# --- vectors ---------------------------------------------------------------------


def test_nearest_vectors(spark):
    rng = np.random.default_rng(2)
    rows = [(i, rng.normal(size=8).tolist()) for i in range(400)]
    rows += [(1000 + i, rows[0][1]) for i in range(150)]  # many copies of one vector
    rows += [(2000, None), (2100, [0.0] * 8), (2200, [float("nan")] * 8), (2300, [1.0] * 7 + [None]), (None, [1.0] * 8), (2400, [1.0])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = permutations.nearest(table, F.col("vec_id") % 100 == 0).collect()
    good = {i: np.array(v, np.float32).astype(float) for i, v in rows[:550]}
    hits = total = 0
    for q in (i for i in good if i % 100 == 0):
        exact = sorted((float(np.sqrt(((good[i] - good[q]) ** 2).sum())), i) for i in good if i != q)[:10]
        own = sorted((r.rank, r.vec_id, r.score) for r in got if r.query_id == q)
        assert [r for r, _, _ in own] == list(range(1, 11))
        assert [(s, i) for _, i, s in own] == sorted((s, i) for _, i, s in own)
        hits += len({i for _, i in exact} & {i for _, i, _ in own})
        total += 10
    assert hits >= 0.9 * total
    assert {r.query_id for r in got} == {i for i in good if i % 100 == 0}


def test_dense_regions_are_found(spark):
    rng = np.random.default_rng(4)
    centres, own = rng.normal(size=(20, 32)), rng.integers(0, 20, 6000)
    own[rng.random(6000) < 1 / 3] = 0  # a third of the rows lie near one vector
    good = centres[own] + rng.normal(size=(6000, 32)) * np.where(own == 0, 0.05, 0.3)[:, None]
    table = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(good)], "vec_id long, embedding array<double>")
    got = {}
    for r in permutations.nearest(table, F.col("vec_id") % 100 == 0).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    hits = {True: [], False: []}
    for q in range(0, 6000, 100):
        apart = ((good - good[q]) ** 2).sum(axis=1)
        apart[q] = np.inf
        assert len(got[q]) == 10
        hits[bool(own[q] == 0)].append(len(got[q] & set(np.argsort(apart)[:10].tolist())) / 10)
    assert np.mean(hits[True]) >= 0.9 and np.mean(hits[False]) >= 0.9


def test_footrule_and_places():
    rng = np.random.default_rng(5)
    away = rng.normal(size=(6, 40))
    found = permutations.places(away).astype(np.int16)
    orders = [sorted(range(40), key=lambda p, r=r: r[p]) for r in away.tolist()]
    for i, order in enumerate(orders):
        brute = [sum(abs(o.index(p) - order.index(p)) for p in range(40)) for o in orders]
        assert permutations.footrule(found.T, found[i]).tolist() == brute
        assert permutations._nearest_first(away, 7)[i].tolist() == order[:7]


def test_few_vectors(spark):
    table = spark.createDataFrame([(0, [1.0, 0.0]), (5, [0.0, 1.0]), (6, [1.0, 1.0])], "vec_id long, embedding array<float>")
    got = permutations.nearest(table, F.col("vec_id") % 100 == 0).orderBy("rank").collect()
    assert [(r.query_id, r["rank"], r.vec_id) for r in got] == [(0, 1, 6), (0, 2, 5)]


# --- packing, lengths ------------------------------------------------------------


def test_bounds_are_optimal():
    from itertools import combinations

    rng = np.random.default_rng(3)
    for _ in range(60):
        lengths = sorted(rng.choice(60, rng.integers(1, 9), replace=False).tolist())
        counts, k = rng.integers(1, 9, len(lengths)).tolist(), int(rng.integers(1, 5))
        cost = lambda bounds: sum(c * min(b for b in bounds if b >= n) for n, c in zip(lengths, counts))  # noqa: B023, E731
        best = min(
            cost([*some, lengths[-1]])
            for r in range(min(k, len(lengths)))
            for some in combinations(lengths[:-1], r)
        )
        found = packing.optimal_bounds(lengths, counts, k)
        assert len(found) <= k and cost(found) == best


def test_packing(spark, monkeypatch):
    monkeypatch.setattr(packing, "GROUP", 7)
    lengths = [1, 0, None, 5, 5, 5, 90, 4000, 5000, 70_000, *range(1, 60)]
    rows = spark.createDataFrame([(i, n, 0) for i, n in enumerate(lengths)], "doc_id long, n int, batch int")
    got = packing.pack(rows, "n", buckets=4, budget=200).collect()
    assert len(got) == len(lengths)
    batches = collections.defaultdict(list)
    for r in got:
        assert max(r.n or 0, 1) <= r.padded_length
        batches[r.bucket, r.batch].append(r.place)
        length = r.padded_length
        assert r.place < max(1, 200 // length)
    assert all(sorted(p) == list(range(len(p))) for p in batches.values())
    # Only the last batch of a bucket may have room.
    for bucket in {b for b, _ in batches}:
        sizes = [len(batches[bucket, k]) for k in range(max(k for b, k in batches if b == bucket) + 1)]
        assert len(set(sizes[:-1])) <= 1


def test_long_lengths_have_exact_bounds(spark):
    rng = np.random.default_rng(4)
    lengths = np.sort(rng.choice(3_000_000, 90, replace=False) + 1)
    rows = spark.createDataFrame([(i, int(n)) for i, n in enumerate(lengths)], "doc_id long, n long")
    got = packing.pack(rows, "n", buckets=5).select("n", "padded_length").collect()
    # Every way to cut, by plain recursion over the lengths.
    least = {0: np.concatenate([[0], np.full(90, np.inf)])}
    for k in range(1, 6):
        before = least[k - 1]
        costs = [min(before[j] + (i - j) * lengths[i - 1] for j in range(i)) for i in range(1, 91)]
        least[k] = np.array([0, *costs])
    assert sum(r.padded_length for r in got) == least[5][90]
    assert all(r.n <= r.padded_length for r in got)


def test_bounds_of_very_many_lengths():
    lengths = np.arange(1, 200_001)
    found = packing.optimal_bounds(lengths, np.ones(200_000, np.int64), 16)
    # Lengths that occur alike are cut into equal parts.
    assert found == list(range(12_500, 200_001, 12_500))


def test_word_lengths(docs):
    tokens = set(byte_pieces.read_ranks(LATIN))
    longest = max(map(len, tokens))

    def greedy(word):
        n = i = 0
        while i < len(word):
            i += next(k for k in range(min(longest, len(word) - i), 0, -1) if word[i : i + k] in tokens)
            n += 1
        return n

    got = [tuple(r) for r in word_lengths.word_lengths(docs, LATIN).collect()]
    split = [(d, WORD.findall(t)) for d, t in TEXTS]
    same(got, [(d, len(w), sum(greedy(b" " + x.encode()) for x in w)) for d, w in split])


def test_very_long_words(spark):
    tokens = set(byte_pieces.read_ranks(LATIN))
    longest = max(map(len, tokens))
    rng = np.random.default_rng(8)
    words = ["".join(rng.choice(list("abcdeéß日the"), 30_000)) for _ in range(3)] + ["x" * 3_000_000, "ab", "the"] * 2

    def greedy(word):
        n = i = 0
        while i < len(word):
            i += next(k for k in range(min(longest, len(word) - i), 0, -1) if word[i : i + k] in tokens)
            n += 1
        return n

    rows = spark.createDataFrame(list(enumerate(words)) + [(90, " ".join(words))], "doc_id long, text string")
    got = {r.doc_id: r.n_tokens for r in word_lengths.word_lengths(rows, LATIN).collect()}
    expected = {w: greedy(b" " + w.encode()) for w in set(words)}
    assert got == {**{i: expected[w] for i, w in enumerate(words)}, 90: sum(map(expected.get, words))}


# --- empty tables ----------------------------------------------------------------


def test_empty_tables(spark, none, tmp_path):
    path = public_tokenizers.path("word_bpe_49k.json")
    direct_codes.write(none, str(tmp_path / "t"), path)
    made = [
        divergence.judge(none),
        secrets.find(none),
        byte_pieces.decode(byte_pieces.encode(none, RANKS, public_tokenizers.PATTERN), RANKS),
        direct_codes.read(spark, str(tmp_path / "t")),
        simhash.near_duplicates(none),
        rule_ensemble.classify(none, (0.0, [])),
        hyperlang.identify(none, *hyperlang.learn(none)),
        permutations.nearest(none.selectExpr("doc_id AS vec_id", "array(1.0) AS embedding"), F.lit(True)),
        packing.pack(none, "n_chars"),
        word_lengths.word_lengths(none, LATIN),
    ]
    assert [df.count() for df in made] == [0] * len(made)
