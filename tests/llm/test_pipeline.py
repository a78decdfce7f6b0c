"""The pipeline on a small table, against what each stage has to do to it."""

import numpy as np

import corpus_pipeline
from footfall.llm.common import table
from tests.llm.test_operators import brute_fingerprint, measured


def folder_of(spark, path):
    word = lambda i, k: ["the", "of", f"u{i * 13 + k}", "and", f"w{i * 31 + k}", f"v{i * 17 + k * 3}"][(i + k * 5) % 6]
    texts = {i: " ".join(word(i, k) for k in range(80)) for i in range(40)}
    texts[50] = texts[3]  # a copy
    texts[51] = "same words again " * 30  # repeated windows
    texts[52] = "too short"
    texts[53] = texts[4].replace("w", "z") + ' token = "abc123DEF456"'
    rows = [(i, t, "en", f"s{i % 5}", len(t)) for i, t in texts.items()] + [(60, None, "en", "s1", None)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(
        f"{path}/documents.parquet"
    )
    labels = spark.createDataFrame([(i, 1, 0) for i in range(40)], "doc_id long, quality int, toxic int")
    labels.write.parquet(f"{path}/labels.parquet")
    return texts


def test_every_stage_takes_effect(spark, tmp_path):
    texts, docs = folder_of(spark, str(tmp_path)), table(spark, str(tmp_path), "documents")
    failed = {i for i, t in texts.items() if (m := measured(t))[0] < 10 or 100 * m[4] > 20 * m[0]}
    left = set(texts) - failed
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, str(tmp_path)).write.parquet(str(tmp_path / f"{k}"))
        docs = spark.read.parquet(str(tmp_path / f"{k}"))
        if name == "near duplicates":
            prints = {i: brute_fingerprint(texts[i]) for i in left}
            stays = set()
            while left:
                group, new = set(), {min(left)}
                stays |= new
                while new:
                    group |= new
                    near = lambda i: any(bin(prints[i] ^ prints[j]).count("1") <= 4 for j in new)  # noqa: B023, E731
                    new = {i for i in left - group if near(i)}
                left -= group
            left = stays
            assert 50 not in left
        assert {r.doc_id for r in docs.select("doc_id").collect()} == left, name
        if name != "packing":
            assert docs.columns == corpus_pipeline.COLUMNS
        if name == "secret scan":
            got = {r.doc_id: r for r in docs.collect()}
            assert got[53].text.endswith("[SECRET]\"") and got[53].n_chars == len(got[53].text)
            assert all(got[i].text == texts[i] for i in left - {53})
    assert docs.columns == ["doc_id", "n_tokens", "bucket", "padded_length", "batch", "place"]


def test_near_copies_go_as_far_as_the_contract_links_them(spark):
    rng = np.random.default_rng(6)
    texts = {}
    for i in range(40):
        words = [f"d{i}x{k}" for k in range(400)]
        texts[100 * i] = " ".join(words)
        for e in range(1, 8):  # copies with ever more changed words
            copy = list(words)
            for k in rng.choice(400, e, replace=False):
                copy[k] = f"new{i}e{e}k{k}"
            texts[100 * i + e] = " ".join(copy)
    docs = spark.createDataFrame(
        [(i, t, "en", "s", 1) for i, t in texts.items()],
        "doc_id long, text string, lang string, source string, n_chars long",
    )
    prints = {i: brute_fingerprint(t) for i, t in texts.items()}
    left, stay = set(texts), set()
    while left:
        group, new = set(), {min(left)}
        stay |= new
        while new:
            group |= new
            new = {i for i in left - group if any((prints[i] ^ prints[j]).bit_count() <= 4 for j in new)}
        left -= group
    assert len(stay) < len(texts) - 40  # near copies are among those that go
    assert {r.doc_id for r in corpus_pipeline.near_duplicates(spark, docs, None).collect()} == stay


def test_one_row_of_each_group_stays(spark):
    long = lambda name: " ".join(f"{name}{k}" for k in range(50))
    a, b, c, d = map(long, "abcd")
    rows = [(7, a), (7, a), (7, b), (5, b), (None, c), (None, c), (None, d), (9, d), (None, long("e"))]
    docs = spark.createDataFrame(
        [(i, t, "en", "s", 1) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long"
    )
    got = [(r.doc_id, r.text) for r in corpus_pipeline.near_duplicates(spark, docs, None).collect()]
    expected = [(7, a), (5, b), (None, c), (9, d), (None, long("e"))]
    assert sorted(got, key=repr) == sorted(expected, key=repr)


def test_no_stage_stumbles_over_nulls(spark, tmp_path):
    folder_of(spark, str(tmp_path))
    rows = [(None, None, None, None, None), (1, None, "en", "s", 1), (1, "", None, "s", 0), (2, "word", "en", None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    left = {name: sorted(map(repr, stage(spark, docs, str(tmp_path)).select("doc_id").collect())) for name, stage in corpus_pipeline.STAGES}
    of = lambda *ids: sorted(f"Row(doc_id={i})" for i in ids)
    assert left["quality rules"] == []  # fewer than ten words
    assert left["near duplicates"] == of(1, 2)  # texts without words are one group
    assert left["secret scan"] == left["packing"] == of(None, 1, 1, 2)


def test_empty_tables_give_empty_results(spark, tmp_path):
    folder_of(spark, str(tmp_path / "full"))
    for name in ("documents", "labels"):
        spark.read.parquet(f"{tmp_path}/full/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    found = corpus_pipeline.run(spark, str(tmp_path))
    assert found.count() == 0 and found.columns == ["doc_id", "n_tokens", "bucket", "padded_length", "batch", "place"]
