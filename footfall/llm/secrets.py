"""Secret scan with corpus-wide ownership frequency.

Native: DataFrame functions only.

Base patterns give spans that always stay. A wider pattern proposes further candidates:
long tokens that mix cases and digits. Only the hash of a candidate leaves its document.
Hashes are counted by distinct repositories and owners over the corpus. A value that at
least ``COPIED_OWNERS`` owners or ``COPIED_REPOS`` repositories hold is a copied example, so
mass copies inside one owner are no credential; a live-looking value of fewer is one, also if
a copy of its document lies with a second owner. Credentials are added to the spans.

Defined results: a null text has no spans; a null owner counts as one owner; without a
repository column every row is a repository of its own; repeated rows each get a result;
an empty table gives an empty table; other columns are not read. Offsets count code
points, the end is exclusive.
"""

from pyspark.sql import functions as F

from .common import checkpoint, whole_text

ASSIGN = (
    "(?i)(password|passwd|secret|token|api_?key)[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
# A whole run is long enough exactly if it matches the bounded form.
PATTERNS = {
    "assign": (ASSIGN, 2),
    "access": ("AKIA[A-Z0-9]{16,}", 0),
    "hex": ("[0-9a-f]{24,}", 0),
    "opaque": ("[A-Za-z0-9_-]{24,}", 0),
}
KINDS = list(PATTERNS)
BASE = KINDS[:3]
ASSIGN_LEAST = 6
PLACEHOLDER = "(?i)example|sample|dummy|placeholder|changeme|your[_-]|xxxx|0000|1234"
DISTINCT_CHARACTERS = 10  # of a live-looking value
COPIED_OWNERS = 3  # owners that hold an example
COPIED_REPOS = 50  # or repositories, of however few owners


def _spans(kind):
    """Spans of a kind from its matches, their values and the text between them."""
    order = KINDS.index(kind)
    ends = F.aggregate(
        F.sequence(F.lit(0), F.size(f"_m_{kind}") - 1),
        F.array().cast("array<int>"),
        lambda done, i: F.array_append(
            done,
            F.coalesce(F.get(done, i - 1), F.lit(0))
            + F.length(F.get(f"_p_{kind}", i))
            + F.length(F.get(f"_m_{kind}", i)),
        ),
    )
    made = F.transform(
        ends,
        lambda end, i: F.struct(
            (end - F.length(F.get(f"_m_{kind}", i))).alias("start"),
            F.lit(order).alias("kind"),
            end.alias("end"),
            F.get(f"_v_{kind}", i).alias("value"),
        ),
    )
    return F.when(F.size(f"_m_{kind}") > 0, made).otherwise(
        F.array().cast("array<struct<start:int,kind:int,end:int,value:string>>")
    )


def candidates(docs, text="text"):
    """``docs`` with the array ``_spans`` of (start, kind, end, hash, live); base kinds are never dropped."""
    none = F.array().cast("array<string>")
    rows = docs.withColumn("_text", whole_text(text))
    for kind, (pattern, _) in PATTERNS.items():
        hit = F.col("_text").rlike(pattern)
        rows = rows.withColumn(
            f"_m_{kind}",
            F.when(hit, F.regexp_extract_all("_text", F.lit(pattern), F.lit(0))).otherwise(none),
        )
    for kind, (pattern, group) in PATTERNS.items():
        hit = F.size(f"_m_{kind}") > 0
        value = F.regexp_extract_all("_text", F.lit(pattern), F.lit(group)) if group else F.col(f"_m_{kind}")
        rows = rows.withColumn(f"_v_{kind}", F.when(hit, value).otherwise(none))
        rows = rows.withColumn(f"_p_{kind}", F.when(hit, F.split("_text", pattern, -1)).otherwise(none))
    rows = rows.select(
        *[F.col(f"`{c}`") for c in docs.columns],
        F.concat(
            F.filter(_spans("assign"), lambda s: F.length(s["value"]) >= ASSIGN_LEAST),
            _spans("access"),
            _spans("hex"),
        ).alias("_base"),
        F.filter(
            _spans("opaque"),
            lambda s: s["value"].rlike("[a-z]") & s["value"].rlike("[A-Z]") & s["value"].rlike("[0-9]"),
        ).alias("_more"),
    )
    apart = F.filter(
        "_more",
        lambda s: ~F.exists("_base", lambda b: (s["start"] < b["end"]) & (b["start"] < s["end"])),
    )
    live = lambda v: ~v.rlike(PLACEHOLDER) & (
        F.size(F.array_distinct(F.split(v, ""))) >= DISTINCT_CHARACTERS
    )
    spans = F.transform(
        F.array_sort(F.concat("_base", apart)),
        lambda s: F.struct(
            s["start"], s["kind"], s["end"], F.sha2(s["value"], 256).alias("hash"), live(s["value"]).alias("live")
        ),
    )
    return rows.withColumn("_spans", spans).drop("_base", "_more")


def ownership(found):
    """Owners and repositories of each hash; found: rows of (hash, owner, repo)."""
    return (
        found.select("hash", "owner", "repo")
        .distinct()
        .groupBy("hash", "owner")
        .agg(F.count("*").alias("repos"))
        .groupBy("hash")
        .agg(F.count("*").alias("n_owners"), F.sum("repos").alias("n_repos"))
    )


def find(docs, ids=("doc_id",), text="text", owner="source", repo=None):
    """One row per row of ``docs``: the id columns and ``spans``.

    Spans are structs (start, kind, end, n_owners, n_repos, status), by start and kind.
    Status is ``copied`` for values of at least ``COPIED_OWNERS`` owners or ``COPIED_REPOS``
    repositories, ``live`` for others that look live, else ``unclear``. Of the wider kind
    only live ones are spans.
    """
    picked = docs.select(
        F.monotonically_increasing_id().alias("_row"),
        F.struct(*[F.col(f"`{c}`") for c in ids]).alias("_ids"),
        F.col(f"`{owner}`").cast("string").alias("_owner"),
        (F.col(f"`{repo}`").cast("string") if repo else F.lit(None).cast("string")).alias("_repo"),
        F.col(f"`{text}`").alias("_raw"),
    )
    # The texts are scanned once; what is left of them is small.
    scanned = checkpoint(
        candidates(picked, "_raw").select(
            "_row",
            "_ids",
            "_owner",
            (F.col("_repo") if repo else F.col("_row").cast("string")).alias("_repo"),
            "_spans",
        )
    )
    single = (
        scanned.where(F.size("_spans") > 0)
        .select("_row", "_ids", "_owner", "_repo", F.explode("_spans").alias("s"))
        .select("_row", "_ids", F.col("_owner").alias("owner"), F.col("_repo").alias("repo"), "s", "s.hash")
    )
    # A hash that many rows hold makes a skewed join, which adaptive execution splits.
    joined = single.drop("owner", "repo").join(ownership(single), "hash")
    status = (
        F.when((F.col("n_owners") >= COPIED_OWNERS) | (F.col("n_repos") >= COPIED_REPOS), "copied")
        .when(F.col("s.live"), "live")
        .otherwise("unclear")
    )
    span = F.struct(
        F.col("s.start").alias("start"),
        F.col("s.kind").alias("order"),
        F.col("s.end").alias("end"),
        F.element_at(F.array(*map(F.lit, KINDS)), F.col("s.kind") + 1).alias("kind"),
        "n_owners",
        "n_repos",
        status.alias("status"),
    )
    kept = (F.col("span.order") < len(BASE)) | (F.col("span.status") == "live")
    some = (
        joined.select("_row", "_ids", span.alias("span"))
        .groupBy("_row")
        .agg(
            F.first("_ids").alias("_ids"),
            F.array_sort(F.collect_list(F.when(kept, F.col("span")))).alias("spans"),
        )
        .select("_ids.*", "spans")
    )
    empty = F.array().cast(some.schema["spans"].dataType)
    return scanned.where(F.size("_spans") == 0).select("_ids.*", empty.alias("spans")).unionByName(some)


def notation(spans):
    """kind:start:end, joined by commas."""
    return F.array_join(
        F.transform(
            spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
        ),
        ",",
    )


def redact(text, spans, mask="[SECRET]"):
    """The text with the characters of all spans, which may overlap, masked."""
    start = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))
    done = F.aggregate(
        spans,
        start,
        lambda a, s: F.when(
            s["start"] >= a["at"],
            F.struct(
                F.concat(a["out"], F.substring(text, a["at"] + 1, s["start"] - a["at"]), F.lit(mask)).alias("out"),
                s["end"].alias("at"),
            ),
        ).otherwise(
            F.struct(a["out"].alias("out"), F.greatest(a["at"], s["end"]).alias("at"))
        ),
        lambda a: F.concat(a["out"], F.substring(text, a["at"] + 1, F.length(text))),
    )
    return F.when(F.size(spans) > 0, done).otherwise(text)
