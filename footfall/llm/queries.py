"""The dealt operators as queries over whole tables, with the columns their contracts name."""

import public_tokenizers
from pyspark.sql import functions as F

from ..session import scratch_dir
from . import (
    block_names,
    byte_pieces,
    direct_codes,
    divergence,
    hyperlang,
    packing,
    pair_counts,
    permutations,
    ranked_search,
    rule_ensemble,
    secrets,
    simhash,
    word_lengths,
)
from .common import checkpoint, remainder, table


def secret_scan(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    found = secrets.find(docs)
    base = F.filter("spans", lambda s: s["order"] < len(secrets.BASE))

    def number(field, value):
        return F.size(F.filter("spans", lambda s: s[field] == F.lit(value))).cast("long")

    counts = [number("order", k).alias(f"n_{kind}") for k, kind in enumerate(secrets.KINDS)]
    by_status = [number("status", status).alias(f"n_{status}") for status in ("live", "copied")]
    return found.select(
        "doc_id",
        *counts[: len(secrets.BASE)],
        F.sha2(secrets.notation(base), 256).alias("base_sha256"),
        secrets.notation("spans").alias("spans"),
        *counts[len(secrets.BASE) :],
        *by_status,
    )


def language_id(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    held_out = remainder(F.col("doc_id"), 4) == 2
    langs, prototypes = hyperlang.learn(docs.where(F.coalesce(~held_out, F.lit(False))))
    found = hyperlang.identify(docs, langs, prototypes)
    return found.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "lang_pred", "score")


def byte_bpe(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    coder = (public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
    return byte_pieces.round_trip(docs, *coder).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("raw", 256).alias("decoded_sha256"),
    )


def token_files(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    path = scratch_dir(spark, "token-files")
    direct_codes.write(docs, path, public_tokenizers.path("word_bpe_49k.json"))
    return direct_codes.read(spark, path)


def near_duplicates(spark, sf_dir):
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def quality_rules(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    judged = divergence.judge(docs)
    return judged.select(
        "doc_id",
        *[
            f"verdict.{name}"
            for name in (
                "n_words",
                "word_chars",
                "n_symbols",
                "n_dup_lines",
                "n_repeat_words",
                "base_failed",
                "kept",
            )
        ],
    )


def quality_classifier(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = remainder(F.col("doc_id"), 5) == 0
    model = rule_ensemble.learn(docs, table(spark, sf_dir, "labels"), ~held_out)
    scored = rule_ensemble.classify(docs, model)
    return scored.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "score", "predicted")


def piece_counts(spark, docs):
    """Token counts of documents, read more than once by packing."""
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return checkpoint(word_lengths.word_lengths(docs, path))


def packed(spark, sf_dir):
    counts = piece_counts(spark, table(spark, sf_dir, "documents"))
    return packing.pack(counts.select("doc_id", "n_tokens"), "n_tokens")


def word_piece_lengths(spark, sf_dir):
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return word_lengths.word_lengths(table(spark, sf_dir, "documents"), path)


def nearest_vectors(spark, sf_dir):
    return permutations.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def ranked(spark, sf_dir):
    return ranked_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def tokenizer_alignment(spark, sf_dir):
    paths = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    return pair_counts.align(table(spark, sf_dir, "documents"), *paths)


def exact_copies(spark, sf_dir):
    return block_names.exact_duplicates(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_secret_scan": secret_scan,
    "op2_language_id": language_id,
    "op3_byte_bpe": byte_bpe,
    "op4_rule_ensemble": quality_classifier,
    "op5_permutation_index": nearest_vectors,
    "op6_length_buckets": packed,
    "op7_token_files": token_files,
    "op8_word_lengths": word_piece_lengths,
    "op9_simhash": near_duplicates,
    "op10_quality_rules": quality_rules,
    "op11_ranked_search": ranked,
    "op12_pair_counts": tokenizer_alignment,
    "op13_block_names": exact_copies,
}
