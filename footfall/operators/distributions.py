"""Numbers behind the figures: levels, histograms, densities, box statistics,
cross-tabulations and cumulative shares.

Values are counted per distinct value first, on the map side, and everything
after that works on distinct values. A *series* column says which curve a value
belongs to (a variable or an activity level); there are only a handful of series
in a figure, so tables with one row per series are small enough to broadcast.
"""

import math

from pyspark.sql import functions as F

from footfall.functions.expressions import ACTIVITY_LEVELS, activity_level, numeric_rows
from footfall.session import checkpoint

# Slices the distinct values of a series are divided into for running totals: BLOCKS
# blocks of BLOCKS slices. Their cuts are quantiles of this accuracy.
BLOCKS = 32
CUT_ACCURACY = 10_000

# Brackets around the quartiles reach this share of the rows to both sides, by the number
# of rows from which it holds; fewer rows are one bracket. Every share is more than twice
# the rank error of quantiles of CUT_ACCURACY and the rounding of a rank together.
BRACKETS = [(1000, 0.0025), (1_000_000, 0.0005)]

# Cells of a density are this part of its bandwidth, and their kernels sums of so many terms.
# With u * t at most REACH / (2 * CELLS), the rest of the series is less than 1e-11 of the sum.
CELLS = 16
TERMS = 16

# Bandwidths at which a Gaussian kernel has become exactly 0: exp(-39 ** 2 / 2).
REACH = 39


# --- series -----------------------------------------------------------------


def as_series(df, columns):
    """(series, value) rows, one series per column, rows complete in all of them."""
    pairs = ", ".join(f"struct('{c}' AS series, {c} AS value)" for c in columns)
    return numeric_rows(df, columns).selectExpr(f"inline(array({pairs}))")


def by_activity_level(rows, largest):
    """Rows of (active_days, value, ...) with the activity level as their series."""
    return (
        rows.select("*", largest.alias("largest"))
        .withColumn("series", F.expr(activity_level("active_days", "largest")))
        .filter("series IS NOT NULL")
        .drop("active_days", "largest")
    )


def _days_and_values(users, column, keep=()):
    return numeric_rows(users, ["active_days", column], keep).withColumnRenamed(column, "value")


def _largest_days(rows):
    return rows.agg(F.expr("max(active_days) AS n")).scalar()


def value_counts(rows):
    return rows.groupBy("series", "value").agg(F.expr("count(*) AS n"))


def in_slices(counts):
    """``counts`` with the slice of each value and the total of its series.

    Approximate quantiles depend on the order in which partial results arrive, so the cuts
    are written down: every use of the result then has the same slices.
    """
    slices = BLOCKS * BLOCKS
    shares = ", ".join(f"{i / slices}D" for i in range(1, slices))
    cuts = counts.groupBy("series").agg(
        F.expr(f"percentile_approx(value, array({shares}), {CUT_ACCURACY}) AS cuts"),
        F.expr("sum(n) AS total"),
    )
    below = "(a, c) -> a + if(c < value, 1, 0)"
    blocks = checkpoint(cuts).selectExpr(
        "*", f"transform(sequence({BLOCKS}, {slices - 1}, {BLOCKS}), i -> cuts[i - 1]) AS starts"
    )
    return (
        counts.join(F.broadcast(blocks), "series")
        .selectExpr("*", f"aggregate(starts, 0, {below}) * {BLOCKS} AS block")
        .selectExpr(
            "series",
            "value",
            "n",
            "total",
            f"block + aggregate(slice(cuts, block + 1, {BLOCKS - 1}), 0, {below}) AS slice",
        )
    )


def running_totals(counts):
    """``counts`` with ``until`` (rows up to and including the value) and ``total``.

    A running total over all values would need them sorted in one task. Here the
    values of a series are divided into slices at approximate quantiles of the
    *distinct* values, so slices are alike in size whatever the range holds: a
    stray extreme is one more value and no more. Totals run inside each slice,
    and the rows in the slices before it are added from a table of at most
    ``BLOCKS * BLOCKS`` rows per series. Totals are exact whatever the cuts. ``counts``
    are read several times, so what is costly to repeat should be written before.
    """
    sliced = in_slices(counts)
    earlier = (
        sliced.groupBy("series", "slice")
        .agg(F.expr("sum(n) AS rows"))
        .selectExpr(
            "series",
            "slice",
            "sum(rows) OVER (PARTITION BY series ORDER BY slice) - rows AS earlier",
        )
    )
    within = sliced.selectExpr(
        "*", "sum(n) OVER (PARTITION BY series, slice ORDER BY value) AS within"
    )
    return within.join(F.broadcast(earlier), ["series", "slice"]).selectExpr(
        "series", "value", "n", "earlier + within AS until", "total"
    )


def quartile_counts(rows):
    """Counts of values that give the quartiles of ``rows``, and the brackets of those.

    A first pass finds, for each quartile of a series, two values it must lie between.
    The second counts the values inside these brackets one by one and everything between
    two brackets as one row, the least value there, on the map side. So the rows that are
    shuffled do not grow with the distinct values outside the brackets. Both are written
    to the shared folder: what builds on them uses them several times.
    """
    shares = [0.25, 0.5, 0.75]
    ends = [q + side * reach for _, reach in BRACKETS for q in shares for side in (-1, 1)]
    found = rows.groupBy("series").agg(
        F.expr(f"percentile_approx(value, array({', '.join(f'{e}D' for e in ends)}), {CUT_ACCURACY}) AS p"),
        F.expr("count(*) AS rows"),
        F.expr("min(value) AS least"),
        F.expr("max(value) AS most"),
    )

    def end(quartile, side):
        cases = [
            f"WHEN rows >= {BRACKETS[k][0]} THEN p[{6 * k + 2 * quartile + side}]"
            for k in reversed(range(len(BRACKETS)))
        ]
        return f"CASE {' '.join(cases)} ELSE {('least', 'most')[side]} END"

    ends = [f"{end(q, side)} AS {name}{q}" for q in range(3) for side, name in ((0, "low"), (1, "high"))]
    brackets = checkpoint(found.selectExpr("series", *ends))
    regions = " ".join(f"WHEN value < low{q} THEN {q} WHEN value <= high{q} THEN NULL" for q in range(3))
    counts = (
        rows.join(F.broadcast(brackets), "series")
        .selectExpr("series", "value", f"CASE {regions} ELSE 3 END AS region")
        .groupBy("series", "region", F.expr("if(region IS NULL, value, NULL)").alias("kept"))
        .agg(F.expr("count(*) AS n"), F.expr("min(value) AS value"))
        .select("series", "value", "n")
    )
    return checkpoint(counts), brackets


# --- activity levels ----------------------------------------------------------


def activity_levels(users):
    """Users and share in percent per activity level, empty levels included.

    A single aggregate counts users between consecutive level bounds. The
    highest level that exists takes all counts from its bound upwards.
    """
    between, levels = [], []
    last = len(ACTIVITY_LEVELS) - 1
    for i, (label, lowest, above) in enumerate(ACTIVITY_LEVELS):
        upper = "" if i == last else f" AND active_days < {ACTIVITY_LEVELS[i + 1][1]}"
        between.append(f"count_if(active_days >= {lowest}{upper}) AS c{i}")
        upwards = " + ".join(f"c{j}" for j in range(i, last + 1))
        here = f"c{i}" if i == last else (
            f"if(largest > {ACTIVITY_LEVELS[i + 1][2]}, c{i}, {upwards})"
        )
        levels.append(
            f"struct({i} AS position, '{label}' AS level, {here} AS user_count,"
            f" largest > {above} AS present)"
        )
    total = " + ".join(f"c{i}" for i in range(last + 1))
    return (
        numeric_rows(users, ["active_days"])
        .selectExpr("max(active_days) AS largest", *between)
        .selectExpr(f"{total} AS total", f"inline(array({', '.join(levels)}))")
        .filter("present")
        .selectExpr(
            "position",
            "level",
            "user_count",
            "try_divide(user_count * 100D, total) AS percentage",
        )
    )


# --- histograms ---------------------------------------------------------------


def integer_histogram(df, column):
    """One bin per whole number from 0 to the largest value, empty bins included."""
    counts = (
        numeric_rows(df, [column])
        .filter(f"{column} >= 0")
        .selectExpr(f"floor({column}) AS bin")
        .groupBy("bin")
        .agg(F.expr("count(*) AS count"))
    )
    bins = counts.selectExpr("max(bin) AS largest").selectExpr(
        "explode(sequence(0L, largest)) AS bin"
    )
    return bins.join(counts, "bin", "left").selectExpr("bin", "coalesce(count, 0) AS count")


def equal_width_histogram(df, column, bins, weight=None):
    """``bins`` bins from the smallest to the largest value, the last one closed.

    A constant column gets a range of width 1 around its value. Bin edges are
    ``low + bin * width``; a value that arithmetic puts on the wrong side of an
    edge is moved to the bin whose edges enclose it. A row counts ``weight`` times if
    that column is named.
    """
    if weight is None:
        counts = value_counts(as_series(df, [column]))
    else:
        weighted = numeric_rows(df, [column], keep=[weight]).selectExpr(
            f"inline(array(struct('{column}' AS series, {column} AS value))) AS (series, value)",
            f"{weight} AS weight",
        )
        counts = weighted.groupBy("series", "value").agg(F.expr("sum(weight) AS n"))
    extent = (
        counts.groupBy("series")
        .agg(F.expr("min(value) AS least"), F.expr("max(value) AS most"))
        .selectExpr(
            "series",
            "if(least = most, least - 0.5D, least) AS low",
            "if(least = most, most + 0.5D, most) AS high",
        )
        .selectExpr("*", f"(high - low) / {bins} AS width")
    )

    def edge(number):
        return f"if({number} = {bins}, high, low + {number} * width)"

    filled = (
        counts.join(F.broadcast(extent), "series")
        .selectExpr(
            "*", f"least(floor((value - low) / (high - low) * {bins}), {bins - 1}) AS guess"
        )
        .selectExpr(
            "n",
            f"""CASE WHEN value < {edge('guess')} THEN guess - 1
                     WHEN value >= {edge('(guess + 1)')} AND guess < {bins - 1} THEN guess + 1
                     ELSE guess END AS bin""",
        )
        .groupBy("bin")
        .agg(F.expr("sum(n) AS count"))
    )
    spine = extent.selectExpr("*", f"explode(sequence(0L, {bins - 1}L)) AS bin").selectExpr(
        "bin", f"{edge('bin')} AS bin_low", f"{edge('(bin + 1)')} AS bin_high"
    )
    return spine.join(filled, "bin", "left").selectExpr(
        "bin", "bin_low", "bin_high", "coalesce(count, 0) AS count"
    )


# --- densities ----------------------------------------------------------------


def density(rows, points=200, cut=0.0):
    """Gaussian kernel density per series on an even grid.

    Bandwidth is ``n ** (-1/5)`` sample deviations; the grid runs from ``cut``
    bandwidths below the smallest to as many above the largest value. A series
    with fewer than two distinct values has no density.

    A fast Gauss transform: the range of a series is divided into cells, and values are summed
    up on the map side to the moments of their cell, so the rows that are shuffled are
    cells. With t a value's and u a grid point's distance from the middle of the cell, in
    bandwidths, exp(-(u - t)^2 / 2) = exp(-u^2 / 2) * exp(-t^2 / 2) * (1 + u t + (u t)^2 / 2
    + ...). The error is less than 1e-11 of each sum.
    """
    grid = (
        rows.groupBy("series")
        .agg(
            F.expr("count(*) AS rows"),
            F.expr("stddev_samp(value) * power(count(*), -0.2D) AS bandwidth"),
            F.expr("min(value) AS low"),
            F.expr("max(value) AS high"),
        )
        .filter("bandwidth > 0")
        .selectExpr(
            "series",
            "rows",
            "bandwidth",
            "low",
            f"low - {cut}D * bandwidth AS start",
            f"high + {cut}D * bandwidth AS stop",
        )
        .selectExpr("*", f"(stop - start) / {points - 1} AS step")
    )
    middle = f"low + (cell + 0.5D) * bandwidth / {CELLS}"
    sides = F.broadcast(grid.select("series", "low", "bandwidth"))
    moments, powers = [], ["w"]
    for k in range(TERMS):
        moments.append(F.expr(f"sum({' * '.join(powers)}) AS m{k}"))
        powers.append("t")
    cells = (
        rows.join(sides, "series")
        .selectExpr("*", f"floor((value - low) / bandwidth * {CELLS}) AS cell")
        .selectExpr("series", "cell", f"(value - ({middle})) / bandwidth AS t")
        .selectExpr("series", "cell", "t", "exp(t * t * -0.5D) AS w")
        .groupBy("series", "cell")
        .agg(*moments)
    )
    # Beyond REACH bandwidths the kernel is 0 in double precision.
    low = f"greatest(0, ceil((middle - {REACH} * bandwidth - start) / step))"
    high = f"least({points - 1}, floor((middle + {REACH} * bandwidth - start) / step))"
    series = f"m{TERMS - 1}"
    for k in range(TERMS - 1, 0, -1):  # Horner's scheme, with the factorials
        series = f"(m{k - 1} + u / {k} * {series})"
    kernels = (
        cells.join(F.broadcast(grid), "series")
        .selectExpr("*", f"{middle} AS middle")
        .selectExpr("*", f"int({low}) AS first", f"int({high}) AS last")
        .selectExpr("*", "explode(if(first <= last, sequence(first, last), array())) AS point")
        .selectExpr("*", "(start + point * step - middle) / bandwidth AS u")
        .groupBy("series", "point")
        .agg(F.expr(f"sum(exp(u * u * -0.5D) * {series}) AS kernels"))
    )
    spine = grid.selectExpr("*", f"explode(sequence(0, {points - 1})) AS point")
    return spine.join(kernels, ["series", "point"], "left").selectExpr(
        "series",
        "point",
        "start + point * step AS x",
        f"coalesce(kernels, 0D) / (rows * bandwidth * {math.sqrt(2 * math.pi)}D) AS density",
    )


# --- box statistics -----------------------------------------------------------


def quartiles_of(totals, brackets=None):
    """Quartiles and fences per series, interpolated between exact ranks.

    With ``brackets``, totals are those of ``quartile_counts``, and a rank outside its
    bracket is an error.
    """
    measures, interpolated = [], []
    for name, share in (("q1", 0.25), ("median", 0.5), ("q3", 0.75)):
        position = f"((total - 1) * {share}D)"
        for side, rank in (("below", f"floor{position}"), ("above", f"ceil{position}")):
            measures.append(
                F.expr(
                    f"max(if(until - n <= {rank} AND {rank} < until, value, NULL))"
                    f" AS {name}_{side}"
                )
            )
        measures.append(F.expr(f"max({position} - floor{position}) AS {name}_part"))
        interpolated.append(
            f"{name}_below + ({name}_above - {name}_below) * {name}_part AS {name}"
        )
    ranked = totals.groupBy("series").agg(F.expr("max(total) AS count"), *measures)
    if brackets is not None:
        inside = " AND ".join(
            f"{name}_below >= low{q} AND {name}_above <= high{q}" for q, name in enumerate(("q1", "median", "q3"))
        )
        ranked = ranked.join(F.broadcast(brackets), "series").filter(
            f"if({inside}, true, raise_error('a quartile lies outside its bracket'))"
        )
    return (
        ranked.selectExpr("series", "count", *interpolated)
        .selectExpr(
            "*", "q1 - (q3 - q1) * 1.5D AS fence_low", "q3 + (q3 - q1) * 1.5D AS fence_high"
        )
    )


def box_stats(users, column):
    """Box figures of ``column`` per activity level, empty levels included.

    Whiskers end at the furthest values within 1.5 quartile ranges of the box.
    Everything is computed from the distinct (active days, value) pairs.
    """
    pairs = checkpoint(
        _days_and_values(users, column)
        .groupBy("active_days", "value")
        .agg(F.expr("count(*) AS pairs"))
    )
    largest = _largest_days(pairs)
    counts = (
        by_activity_level(pairs, largest)
        .groupBy("series", "value")
        .agg(F.expr("sum(pairs) AS n"))
    )
    fences = quartiles_of(running_totals(counts))
    inside = "value BETWEEN fence_low AND fence_high"
    boxes = (
        counts.join(F.broadcast(fences), "series")
        .groupBy("series")
        .agg(
            F.expr("max(count) AS count"),
            F.expr("max(q1) AS q1"),
            F.expr("max(median) AS median"),
            F.expr("max(q3) AS q3"),
            F.expr(f"min(if({inside}, value, NULL)) AS lowest"),
            F.expr(f"max(if({inside}, value, NULL)) AS highest"),
            F.expr(f"sum(if({inside}, 0, n)) AS outliers"),
        )
        .withColumnRenamed("series", "level")
    )
    levels = ", ".join(
        f"struct({i} AS position, '{label}' AS level, {above} AS above)"
        for i, (label, _, above) in enumerate(ACTIVITY_LEVELS)
    )
    spine = (
        pairs.agg(F.expr("max(active_days) AS largest"))
        .selectExpr("largest", f"inline(array({levels}))")
        .filter("largest > above")
    )
    return spine.join(boxes, "level", "left").selectExpr(
        "position",
        "level",
        "coalesce(count, 0) AS count",
        "q1",
        "median",
        "q3",
        "if(q1 IS NULL, NULL, least(lowest, q1)) AS whisker_low",
        "if(q3 IS NULL, NULL, greatest(highest, q3)) AS whisker_high",
        "coalesce(outliers, 0) AS outliers",
    )


def box_outliers(users, column):
    """Users whose value lies outside the fences of their activity level."""
    rows = checkpoint(_days_and_values(users, column, keep=["user_id"]))
    leveled = by_activity_level(rows, _largest_days(rows))
    fences = quartiles_of(running_totals(value_counts(leveled)))
    return (
        leveled.join(F.broadcast(fences.select("series", "fence_low", "fence_high")), "series")
        .filter("value NOT BETWEEN fence_low AND fence_high")
        .selectExpr("user_id", "series AS level", "value")
    )


def violin_densities(users, column):
    """Density of ``column`` per activity level, drawn two bandwidths past the data."""
    rows = _days_and_values(users, column)
    return density(by_activity_level(rows, _largest_days(rows)), points=100, cut=2.0)


# --- tables -------------------------------------------------------------------


def crosstab(df, row, column):
    """Frequencies of the pairs of values that occur; every other pair has none."""
    return numeric_rows(df, [row, column]).groupBy(row, column).agg(F.expr("count(*) AS count"))


def crosstab_axis(df, column, other):
    """The values on one axis of ``crosstab(df, column, other)``, with their totals."""
    return (
        numeric_rows(df, [column, other])
        .groupBy(column)
        .agg(F.expr("count(*) AS count"))
        .withColumnRenamed(column, "value")
    )


def cumulative_shares(df, column):
    """Share of rows at or below each distinct value."""
    totals = running_totals(checkpoint(value_counts(as_series(df, [column]))))
    return totals.selectExpr("value", "n", "until / total AS share")


def scatter(df, x, y):
    return numeric_rows(df, [x, y])
