"""Quality rules: repetition counts and divergence from language references.

Native: DataFrame functions only.

Every text is described by its word, symbol and repetition counts (the base rules) and
by two histograms, of character classes and of the most common words of its language.
The references are the same histograms summed over all documents of a language. A
document is rejected if it fails a base rule or if the Jensen-Shannon distance of a
histogram to the reference of its language is too large. Short texts give histograms
that are mostly noise, so each comparison has a least length; so do the references.

Defined results: a null text is empty (no words, fails the base rules); a document whose
language is null or has no reference is judged by the base rules alone; repeated rows
are judged each; an empty table gives an empty table; columns other than the
identifier, text and language are not touched, and a column that has the name of the
verdict is replaced.
"""

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import SPACES, checkpoint, keep, let, whole_text

# Character classes besides white space and all the rest.
CLASSES = {
    "upper": "\\P{Lu}+",
    "digit": "[^0-9]+",
    "punctuation": "[^.,;:!?'\"()-]+",
    "symbol": "[^#*$%&|<>]+",
}
COMMON_WORDS = 24  # words of a language's reference
MOST_BROADCAST = 10_000  # references, of 24 hashes and 31 shares each, that a broadcast may hold
REFERENCE_WORDS = 1000  # words a language needs to have a reference
CLASS_LIMIT, CLASS_WORDS = 0.33, 60  # largest distance, least number of words
WORD_LIMIT, WORD_WORDS = 0.31, 100


def words_of(text):
    return F.array_remove(F.split(text, SPACES), "")


def class_counts(text, words):
    """Characters by class: upper, digit, punctuation, symbol, all but white space; and all.

    Most characters are blanks and lower-case Latin letters; classes are told apart without
    them. ``words`` are those of the text.
    """

    def counts(others):
        parts = [F.length(F.regexp_replace(others, other, "")) for other in CLASSES.values()]
        return F.array(*parts, F.length(F.array_join(words, "")))

    return let(F.regexp_replace(text, "[a-z \n\u00DF-\u00F6\u00F8-\u00FF]+", ""), counts), F.length(text)


def _classes(text, words):
    """Characters by class: upper, digit, punctuation, symbol, white space, rest."""
    counts, length = class_counts(text, words)
    return let(
        counts,
        lambda c: F.array(
            *[c[i] for i in range(len(CLASSES))],
            length - c[len(CLASSES)],
            c[len(CLASSES)] - sum((c[i] for i in range(1, len(CLASSES))), c[0]),
        ),
    )


def references(docs, lang="lang", text="text"):
    """One row per language: words, their shares (and the share of all others), class shares.

    Texts are read once: their sums are counted beside their words, as notes that begin with a
    blank, which no word does.
    """
    base = docs.where(F.col(lang).isNotNull()).select(
        F.col(lang).cast("string").alias("lang"), whole_text(text).alias("text")
    )
    split = base.withColumn("words", words_of(F.col("text"))).withColumn("c", _classes(F.col("text"), F.col("words")))
    total = len(CLASSES) + 2
    values = [F.size("words"), *[F.col("c")[i] for i in range(total)]]
    notes = F.array(*[F.concat(F.lit(f" {i} "), value.cast("string")) for i, value in enumerate(values)])
    counts = checkpoint(
        split.select("lang", F.explode(F.concat("words", notes)).alias("word"))
        .groupBy("lang", "word")
        .agg(F.count("*").alias("n"))
    )
    note = F.split("word", " ")
    noted = counts.where(F.col("word").startswith(" ")).select(
        "lang", note[1].cast("int").alias("i"), (note[2].cast("bigint") * F.col("n")).alias("sum")
    )
    sums = (
        noted.groupBy("lang")
        .agg(*[F.sum(F.when(F.col("i") == i, F.col("sum")).otherwise(0)).alias(f"s{i}") for i in range(total + 1)])
        .select("lang", F.col("s0").alias("n_words"), F.array(*[f"s{i + 1}" for i in range(total)]).alias("classes"))
        .where(F.col("n_words") >= REFERENCE_WORDS)
    )
    # Rank within shares of each language first: no task sorts all words of one language.
    order = [F.desc("n"), F.col("word")]
    shares = Window.partitionBy("lang", "share").orderBy(*order)
    ranked = (
        counts.where(~F.col("word").startswith(" "))
        .withColumn("share", F.pmod(F.hash("word"), F.lit(64)))
        .withColumn("rank", F.row_number().over(shares))
        .where(F.col("rank") <= COMMON_WORDS)
    )
    top = (
        ranked.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)))
        .where(F.col("rank") <= COMMON_WORDS)
        .groupBy("lang")
        .agg(F.array_sort(F.collect_list(F.struct("rank", F.xxhash64("word").alias("word"), "n"))).alias("top"))
    )
    return sums.join(top, "lang", "left").select(
        F.col("lang").alias("ref_lang"),
        "n_words",
        F.coalesce(F.col("top.word"), F.array().cast("array<bigint>")).alias("ref_words"),
        let(
            F.coalesce(F.col("top.n"), F.array().cast("array<bigint>")),
            lambda n: F.transform(
                F.concat(n, F.array(F.col("n_words") - F.aggregate(n, F.lit(0).cast("bigint"), lambda a, b: a + b))),
                lambda x: x / F.col("n_words"),
            ),
        ).alias("ref_shares"),
        let(
            F.aggregate("classes", F.lit(0).cast("bigint"), lambda a, b: a + b),
            lambda s: F.transform("classes", lambda x: x / s),
        ).alias("ref_classes"),
    )


def _with_references(rows, refs):
    """``rows`` with the reference of their language, if it has one.

    Up to ``MOST_BROADCAST`` references are broadcast, whose words are hashes of a fixed size. If
    there are more, those of the languages with most words are, and only rows of the others
    are shuffled, each language of which has less than a ``MOST_BROADCAST``-th of all words.
    """
    at = F.col("_lang") == F.col("ref_lang")
    refs = checkpoint(refs)
    if refs.count() <= MOST_BROADCAST:
        return rows.join(F.broadcast(refs), at, "left")
    often = checkpoint(refs.orderBy(F.desc("n_words"), "ref_lang").limit(MOST_BROADCAST))
    found = rows.join(F.broadcast(often), at, "left")
    own = F.broadcast(often.select(F.col("ref_lang").alias("_often")))
    rest = refs.join(own, F.col("ref_lang") == F.col("_often"), "left_anti")
    mine = keep(found, F.col("ref_lang").isNotNull())
    other = keep(found, F.col("ref_lang").isNull()).drop(*refs.columns)
    return mine.unionByName(other.join(rest, at, "left"))


def distance(p, q):
    """Jensen-Shannon distance (base 2) of two share arrays of one length."""

    def term(a, b):
        middle = (a + b) / 2
        half = lambda x: F.when(x > 0, x * F.log2(x / middle)).otherwise(F.lit(0.0))
        return half(a) + half(b)

    total = F.aggregate(F.zip_with(p, q, term), F.lit(0.0), lambda a, b: a + b)
    return F.sqrt(F.greatest(total / 2, F.lit(0.0)))


def _shares(counts):
    total = F.aggregate(counts, F.lit(0).cast("bigint"), lambda a, b: a + b)
    return let(total, lambda s: F.transform(counts, lambda x: F.when(s > 0, x / s).otherwise(F.lit(0.0))))


def _measured(docs, text):
    """Add _words and the base counts, one projection for each value used again."""
    rows = docs.withColumn("_text", whole_text(text)).withColumn("_split", words_of(F.col("_text")))
    # Every word is hashed once.
    rows = rows.withColumn("_words", F.transform("_split", lambda w: F.xxhash64(w)))
    rows = rows.withColumn(
        "_windows",
        F.when(
            F.size("_words") >= 5,
            F.transform(
                F.sequence(F.lit(0), F.size("_words") - 5),
                lambda i: F.xxhash64(*[F.col("_words")[i + j] for j in range(5)]),
            ),
        ).otherwise(F.array().cast("array<bigint>")),
    )
    # Only texts with a repeated window are sorted.
    rows = rows.withColumn(
        "_sorted",
        F.when(
            F.size(F.array_distinct("_windows")) < F.size("_windows"),
            F.sort_array(F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))),
        ),
    )
    again = F.filter(
        "_sorted",
        lambda x, k: (F.get("_sorted", k - 1)["h"] == x["h"]) | (F.get("_sorted", k + 1)["h"] == x["h"]),
    )
    rows = rows.withColumn("_starts", F.sort_array(F.transform(again, lambda x: x["i"])))
    covered = F.aggregate(
        "_starts",
        F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(0).alias("end")),
        lambda a, s: F.struct(
            (a["n"] + s + 5 - F.greatest(a["end"], s)).cast("bigint").alias("n"), (s + 5).alias("end")
        ),
    )["n"]
    lines = F.filter(F.split("_text", "\n"), lambda x: x.rlike("[^\\x20\\x09-\\x0D]"))
    return rows.select(
        "*",
        F.size("_words").cast("bigint").alias("_n_words"),
        _classes(F.col("_text"), F.col("_split")).alias("_classes"),
        let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("bigint").alias("_dup_lines"),
        F.coalesce(covered, F.lit(0)).cast("bigint").alias("_repeat"),
    )


def judge(docs, refs=None, text="text", lang="lang", verdict="verdict"):
    """``docs`` with a struct column ``verdict``: the counts, both distances, base_failed, kept."""
    if refs is None:
        refs = references(docs, lang, text)
    own = [c for c in docs.columns if c.lower() != verdict.lower()]
    # Names of our own: an input column may have any name.
    packed = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in own]).alias("_row") if own else F.lit(None).alias("_row"),
        F.col(text).alias("_raw"),
        F.col(lang).cast("string").alias("_lang"),
    )
    rows = _with_references(_measured(packed, "_raw"), refs)
    symbol = list(CLASSES).index("symbol")
    rows = rows.withColumn(
        "_common", F.filter("_words", lambda w: F.array_contains(F.col("ref_words"), w))
    )
    rows = rows.withColumn(
        "_hits", F.transform("ref_words", lambda r: F.size("_common") - F.size(F.array_remove("_common", r)))
    )
    rows = rows.withColumn(
        "_word_js",
        F.when(
            (F.col("_n_words") > 0) & F.col("ref_lang").isNotNull(),
            distance(
                F.transform(
                    F.concat("_hits", F.array(F.size("_words") - F.size("_common"))),
                    lambda x: x / F.col("_n_words"),
                ),
                F.col("ref_shares"),
            ),
        ),
    ).withColumn(
        "_class_js",
        F.when(
            (F.length("_text") > 0) & F.col("ref_lang").isNotNull(),
            distance(_shares(F.col("_classes")), F.col("ref_classes")),
        ),
    )
    failed = (F.col("_n_words") < 10) | (100 * F.col("_repeat") > 20 * F.col("_n_words"))
    far = (
        (F.col("_n_words") >= CLASS_WORDS) & (F.coalesce("_class_js", F.lit(0.0)) > CLASS_LIMIT)
    ) | ((F.col("_n_words") >= WORD_WORDS) & (F.coalesce("_word_js", F.lit(0.0)) > WORD_LIMIT))
    found = F.struct(
        F.col("_n_words").alias("n_words"),
        (F.length("_text") - F.col("_classes")[len(CLASSES)]).cast("bigint").alias("word_chars"),
        F.col("_classes")[symbol].cast("bigint").alias("n_symbols"),
        F.col("_dup_lines").alias("n_dup_lines"),
        F.col("_repeat").alias("n_repeat_words"),
        failed.alias("base_failed"),
        (~failed & ~far).alias("kept"),
        F.col("_class_js").alias("class_js"),
        F.col("_word_js").alias("word_js"),
    )
    return rows.select("_row.*", found.alias(verdict)) if own else rows.select(found.alias(verdict))
