"""Quality classifier: a sparse ensemble of rules.

Shallow boosted trees are grown on statistics of the text; every path from a root to a
node below it is a rule, a conjunction of comparisons. A logistic model with an L1 penalty
gives most rules weight zero. The rest is compiled into one Spark column expression over
the statistics, so scoring stays in the JVM and moves no rows.

Trees and weights are fitted by the driver on at most ``SAMPLE`` labelled rows, chosen by a
hash of the id. Everything else covers all rows.

Defined results: a null text is empty and gets the score of its statistics (all zero);
labels other than 0 and 1 are not learnt, of several labels of one id the greatest counts;
without labels of both values every score is 0.5; repeated rows get a row each; an empty
table gives an empty table; other columns are not read.
"""

import numpy as np
from pyspark.sql import functions as F

from .common import whole_text
from .divergence import class_counts, words_of

SAMPLE = 20_000
TREES, DEPTH, CUTS, LEAF = 40, 3, 32, 20
RATE = 0.3
PENALTY = 0.002
ROUNDS = 400
STATISTICS = [
    "words",
    "word_length",
    "distinct_words",
    "distinct_pairs",
    "repeated_neighbours",
    "short_words",
    "distinct_lines",
    "words_per_line",
    "upper",
    "digit",
    "punctuation",
    "symbol",
    "space",
    "exclamation",
    "bars",
]


def statistics(rows, text="text"):
    """``rows`` with a double column for each of STATISTICS, all zero for an empty text.

    Pairs are neighbouring words, and the last word with the end.
    """
    rows = rows.withColumn("_text", whole_text(text)).withColumn("_words", words_of(F.col("_text")))
    rows = rows.withColumn(
        "_pairs", F.zip_with("_words", F.slice("_words", 2, 1 << 30), lambda a, b: F.xxhash64(a, b))
    ).withColumn("_lines", F.split("_text", "\n"))
    counts, length = class_counts(F.col("_text"), F.col("_words"))
    rows = rows.withColumn("_classes", counts)
    n, chars, lines = F.size("_words"), length, F.size("_lines")
    share = lambda a, b: F.when(b > 0, a / b).otherwise(F.lit(0.0)).cast("double")
    repeated = F.size(
        F.filter(F.zip_with("_words", F.slice("_words", 2, 1 << 30), lambda a, b: a == b), lambda x: x)
    )
    gone = lambda c: chars - F.length(F.replace("_text", F.lit(c), F.lit("")))
    found = [
        F.log1p(n.cast("double")),
        share(F.col("_classes")[4], n),
        share(F.size(F.array_distinct("_words")), n),
        share(F.size(F.array_distinct("_pairs")), n),
        share(repeated, n),
        share(F.size(F.filter("_words", lambda w: F.length(w) <= 3)), n),
        F.when(n > 0, share(F.size(F.array_distinct("_lines")), lines)).otherwise(0.0),
        F.when(n > 0, share(n, lines)).otherwise(0.0),
        *[share(F.col("_classes")[i], chars) for i in range(4)],
        share(chars - F.col("_classes")[4], chars),
        share(gone("!"), chars),
        share(gone("|"), chars),
    ]
    return rows.select(
        *[c for c in rows.columns if not c.startswith("_") and c != text],
        *[x.alias(name) for x, name in zip(found, STATISTICS, strict=True)],
    )


def _cuts(x):
    """Candidate thresholds of a statistic, at its quantiles, between values."""
    values = np.unique(np.quantile(x, np.linspace(0, 1, CUTS + 2)[1:-1], method="lower"))
    return values[values < x.max()]


def _tree(bins, cuts, slope, curve, rows, depth, path, rules):
    """Grow below ``rows``; add each node's path to rules; leaf values by row."""
    value = np.zeros(len(slope))
    best = None
    if depth:
        g, h = slope[rows].sum(), curve[rows].sum()
        for f, own in enumerate(cuts):
            if not len(own):
                continue
            at = bins[rows, f]
            size = len(own) + 1
            sums = [np.bincount(at, w, size).cumsum()[:-1] for w in (slope[rows], curve[rows], np.ones(len(rows)))]
            fits = (sums[2] >= LEAF) & (len(rows) - sums[2] >= LEAF)
            if not fits.any():
                continue
            gain = sums[0] ** 2 / (sums[1] + 1) + (g - sums[0]) ** 2 / (h - sums[1] + 1) - g**2 / (h + 1)
            gain = np.where(fits, gain, -np.inf)
            k = int(gain.argmax())
            if gain[k] > 1e-6 and (best is None or gain[k] > best[0]):
                best = (gain[k], f, k)
    if best is None:
        value[rows] = slope[rows].sum() / (curve[rows].sum() + 1)
        return value
    _, f, k = best
    below = bins[rows, f] <= k
    for side, chosen in ((True, rows[below]), (False, rows[~below])):
        rule = (*path, (f, float(cuts[f][k]), side))
        rules.append(rule)
        value += _tree(bins, cuts, slope, curve, chosen, depth - 1, rule, rules)
    return value


def holds(rule, x):
    """Rows of the matrix where every comparison of the rule holds."""
    out = np.ones(len(x), bool)
    for f, cut, below in rule:
        out &= (x[:, f] <= cut) == below
    return out


def extract(x, y):
    """Rules of boosted trees for the labels."""
    cuts = [_cuts(c) for c in x.T]
    bins = np.stack([np.searchsorted(c, v, side="left") for c, v in zip(cuts, x.T, strict=True)], axis=1)
    margin, rules = np.full(len(y), np.log((y.mean() + 1e-9) / (1 - y.mean() + 1e-9))), []
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-margin))
        margin += RATE * _tree(bins, cuts, y - p, p * (1 - p), np.arange(len(y)), DEPTH, (), rules)
    return list(dict.fromkeys(tuple(sorted(set(r))) for r in rules))


def lasso(r, y):
    """Intercept and L1-penalised logistic weights by accelerated proximal steps."""
    mean = r.mean(axis=0)
    z = r - mean
    # A bound of the greatest eigenvalue gives the step length.
    v = np.ones(z.shape[1])
    for _ in range(30):
        v = z.T @ (z @ v)
        v /= np.linalg.norm(v) + 1e-12
    step = 4 * len(y) / (1.05 * np.linalg.norm(z @ v) ** 2 + len(y))
    w = look = np.zeros(z.shape[1] + 1)
    t = 1.0
    for _ in range(ROUNDS):
        error = 1 / (1 + np.exp(-(look[0] + z @ look[1:]))) - y
        new = look - step * np.concatenate([[error.mean()], z.T @ error / len(y)])
        new[1:] = np.sign(new[1:]) * np.maximum(np.abs(new[1:]) - step * PENALTY, 0)
        after = (1 + np.sqrt(1 + 4 * t * t)) / 2
        look, w, t = new + (t - 1) / after * (new - w), new, after
    return w[0] - mean @ w[1:], w[1:]


def fit(x, y):
    """Intercept and (weight, rule) pairs; none without labels of both values."""
    if len(y) == 0 or y.min() == y.max():
        return 0.0, []
    rules = extract(x, y)
    if not rules:
        return float(np.log(y.mean() / (1 - y.mean()))), []
    intercept, weights = lasso(np.stack([holds(r, x) for r in rules], axis=1).astype(float), y)
    return float(intercept), [(float(w), r) for w, r in zip(weights, rules, strict=True) if abs(w) > 1e-6]


def score(model):
    """The model as a column expression over the statistics."""
    intercept, rules = model
    total = F.lit(intercept)
    for weight, rule in rules:
        condition = F.lit(True)
        for f, cut, below in rule:
            c = F.col(STATISTICS[f])
            condition &= (c <= F.lit(cut)) if below else (c > F.lit(cut))
        total += F.when(condition, F.lit(weight)).otherwise(F.lit(0.0))
    return 1 / (1 + F.exp(-total))


def learn(docs, labels, allowed=None, doc_id="doc_id", text="text", label="quality"):
    """A model of the labels; allowed: a condition on doc_id for rows to learn from."""
    marked = labels.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{label}`").alias("y")).where(
        F.col("doc_id").isNotNull() & F.col("y").isin(0, 1)
    )
    if allowed is not None:
        marked = marked.where(allowed)
    marked = marked.groupBy("doc_id").agg(F.max("y").alias("y"))
    most = max(1, marked.count())
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30))
    # A strict bound of SAMPLE rows, of which the share was taken before they are sorted.
    near = marked.where(place < int(min(1.0, 1.2 * SAMPLE / most) * (1 << 30)))
    sample = near.orderBy(place, "doc_id").limit(SAMPLE)
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    # Repeated rows of an id may not outgrow the bound either.
    found = statistics(rows.join(F.broadcast(sample), "doc_id")).orderBy("doc_id").limit(SAMPLE)
    data = found.select("y", *STATISTICS).toPandas()
    return fit(data[STATISTICS].to_numpy(float), data["y"].to_numpy(float))


def classify(docs, model, text="text", threshold=0.3, name="score", decision="predicted"):
    """``docs`` with score and predicted (1 at ``threshold`` or above); such columns are replaced."""
    kept = [c for c in docs.columns if c.lower() not in (name.lower(), decision.lower())]
    held = docs.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row"), F.col(f"`{text}`").alias("text"))
    scored = statistics(held).select("row", score(model).alias("found"))
    return scored.select(
        "row.*", F.col("found").alias(name), (F.col("found") >= threshold).cast("int").alias(decision)
    )
