"""The corpus pipeline: quality rules, classifier, near duplicates, secrets, packing.

Every stage takes what the one before it kept. All but the last return the columns of
``documents``. Every row is a document of its own, also if rows share a doc_id or have none.
"""

from pyspark.sql import functions as F

from footfall.llm import divergence, packing, rule_ensemble, secrets, simhash
from footfall.llm.common import keep, remainder, table
from footfall.llm.queries import piece_counts
from footfall.session import scratch_dir

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
# SQL has neither the classifier nor the fingerprints; tests compare with brute force.
ORACLE_SQL = None


def quality_rules(spark, docs, sf_dir):
    """Documents that fail a rule go."""
    return keep(divergence.judge(docs), F.col("verdict.kept")).select(*COLUMNS)


def quality_classifier(spark, docs, sf_dir):
    """Documents that the classifier rejects go; it learns from labels of documents still here."""
    learnt = remainder(F.col("doc_id"), 5) != 0
    model = rule_ensemble.learn(docs, table(spark, sf_dir, "labels"), learnt)
    return keep(rule_ensemble.classify(docs, model), F.col("predicted") == 1).select(*COLUMNS)


def near_duplicates(spark, docs, sf_dir):
    """One row of each group stays: that of the least doc_id (null last), the first one written.

    Groups are those of the SimHash operator as its contract has it: shingles of four words,
    at most four differing bits. Rows are told apart by a key of their own, not by doc_id.
    """
    path = scratch_dir(spark, "keyed")
    docs.select(*COLUMNS, F.monotonically_increasing_id().alias("_row")).write.parquet(path)
    rows = spark.read.parquet(path)
    found = simhash.near_duplicates(rows, doc_id="_row", keep="doc_id")
    first = F.min(F.struct(F.col("keep").isNull(), "keep", F.col("doc_id").alias("_row"))).alias("first")
    kept = found.groupBy("component_id").agg(first).select(F.col("first._row").alias("_row"))
    return rows.join(kept, "_row", "left_semi").select(*COLUMNS)


def secret_scan(spark, docs, sf_dir):
    """Secrets are masked; their documents stay. n_chars follows the text."""
    keyed = docs.withColumn("_key", F.xxhash64("text"))
    found = secrets.find(keyed, ids=("doc_id", "_key")).where(F.size("spans") > 0)
    found = found.dropDuplicates(["doc_id", "_key"]).withColumnsRenamed({"doc_id": "_id", "_key": "_found"})
    joined = keyed.join(
        found, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_key") == F.col("_found")), "left"
    )
    masked = F.when(F.col("spans").isNotNull(), secrets.redact(F.col("text"), F.col("spans"))).otherwise(
        F.col("text")
    )
    length = F.when(F.col("spans").isNotNull(), F.length("_masked").cast("long")).otherwise(F.col("n_chars"))
    return (
        joined.withColumn("_masked", masked)
        .withColumn("n_chars", length)
        .select("doc_id", F.col("_masked").alias("text"), "lang", "source", "n_chars")
    )


def packed(spark, docs, sf_dir):
    """Every document with its token count, bucket, padded length, batch and place."""
    return packing.pack(piece_counts(spark, docs).select("doc_id", "n_tokens"), "n_tokens")


STAGES = [
    ("quality rules", quality_rules),
    ("quality classifier", quality_classifier),
    ("near duplicates", near_duplicates),
    ("secret scan", secret_scan),
    ("packing", packed),
]


def run(spark, sf_dir):
    """All stages, each written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    folder = scratch_dir(spark, "corpus")
    for k, (_, stage) in enumerate(STAGES):
        path = f"{folder}/{k}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
