"""Pages deep inside a sorted result.

A sort with an offset keeps ``offset + limit`` rows of every task. Beyond ``SHALLOW`` rows the
first row of the page is looked for instead: bounds from a sample cut the keys into ranges,
the rows before each bound are counted, and the range that holds the offset is cut again until
it has at most ``RANGE_ROWS`` rows. Only that range is sorted. The page then starts at a known
key, a filter that reaches the source, and every task keeps ``limit`` rows.
"""

from functools import reduce

from pyspark.sql import functions as F

from footfall.session import checkpoint

SHALLOW = 10_000
RANGE_ROWS = 100_000
BOUNDS = 32
SAMPLE = 2_000


def sort_keys(order):
    """order: (column, descending) in turn; nulls come first, or last where descending."""
    return [F.col(name).desc() if desc else F.col(name).asc() for name, desc in order]


def before(rows, order, bound):
    """Whether a row sorts before ``bound``, a row with the columns of ``order``."""
    result = F.lit(False)
    for name, desc in reversed(order):
        own, other = F.col(name), F.lit(bound[name]).cast(rows.schema[name].dataType)
        if bound[name] is None:
            first = own.isNotNull() if desc else F.lit(False)
        else:
            first = F.coalesce(own > other, F.lit(False)) if desc else F.coalesce(own < other, F.lit(True))
        result = first | (own.eqNullSafe(other) & result)
    return result


def row_at(keys, order, offset):
    """The row at ``offset`` and how many rows sort before it, or None past the end."""
    names = [name for name, _ in order]
    held, n, skipped = keys, keys.count(), 0
    while n > RANGE_ROWS:
        some = held.sample(min(1.0, SAMPLE / n), 7).select(*names).orderBy(*sort_keys(order)).collect()
        bounds = some[:: max(1, len(some) // BOUNDS)]
        if not bounds:
            break
        counts = held.agg(*[F.count_if(before(held, order, b)).alias(f"n{i}") for i, b in enumerate(bounds)]).first()
        low = max((c, i) for i, c in enumerate([0, *counts]) if c <= offset - skipped)
        high = min((c, i) for i, c in enumerate([*counts, n]) if c > offset - skipped or i == len(bounds))
        parts = [~before(held, order, bounds[low[1] - 1])] if low[1] else []
        parts += [before(held, order, bounds[high[1]])] if high[1] < len(bounds) else []
        if high[0] - low[0] == n:
            break  # keys that are all equal
        held, n, skipped = held.filter(reduce(lambda a, b: a & b, parts)), high[0] - low[0], skipped + low[0]
    found = held.orderBy(*sort_keys(order)).offset(offset - skipped).limit(1).collect()
    if not found:
        return None
    return found[0], skipped + held.filter(before(held, order, found[0])).count()


def page(rows, order, offset=None, limit=None):
    """``rows`` in order (see ``sort_keys``), without the first ``offset``, at most ``limit``."""
    if offset and offset > SHALLOW:
        found = row_at(checkpoint(rows.select(*dict.fromkeys(name for name, _ in order))), order, offset)
        if found is None:
            return rows.limit(0)
        first, earlier = found
        rows, offset = rows.filter(~before(rows, order, first)), offset - earlier
    rows = rows.orderBy(*sort_keys(order))
    if offset:
        rows = rows.offset(offset)
    return rows if limit is None else rows.limit(limit)
