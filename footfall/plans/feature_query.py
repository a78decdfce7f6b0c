"""Filtered, sorted and paged reads of user features.

The two forms answer the same options differently and both are kept:

=================  ==============================  ================================
                   ``query_table``                 ``query_cells``
=================  ==============================  ================================
input              user table                      cell table
``user_id``        one more filter                 row key lookup, other options off
``offset``         only together with ``limit``    always
``fields``         exactly these columns           these and ``user_id``; else all
ties               by ``user_id``                  by row key, in both directions
values             typed                           text
=================  ==============================  ================================
"""

from pyspark.sql import functions as F

from footfall.functions.expressions import number
from footfall.operators.cells import decode_all, decode_cells, decode_numbers
from footfall.plans.paging import page, sort_keys
from footfall.schema import STORED_FEATURES


def _bounds(value_of, days, ratio):
    """Conditions of the inclusive ranges that are given."""
    conditions = []
    for column, (low, high) in (("active_days", days), ("buy_ratio", ratio)):
        if low is not None:
            conditions.append(f"{value_of(column)} >= {float(low)!r}D")
        if high is not None:
            conditions.append(f"{value_of(column)} <= {float(high)!r}D")
    return conditions


def query_table(
    users,
    user_id=None,
    top_n=10,
    min_active_days=None,
    max_active_days=None,
    min_buy_ratio=None,
    max_buy_ratio=None,
    order_by=None,
    desc=False,
    fields=None,
    limit=None,
    offset=None,
):
    """Filter, sort, limit, project. Filters and columns reach the source."""
    if user_id is not None:
        users = users.filter(F.col("user_id") == F.lit(user_id).try_cast("bigint"))
    days, ratio = (min_active_days, max_active_days), (min_buy_ratio, max_buy_ratio)
    for condition in _bounds(str, days, ratio):
        users = users.filter(condition)
    rows = limit if limit is not None else top_n
    if order_by or rows is not None:
        order = [(order_by, desc)] if order_by else []
        skipped = offset if limit is not None else None
        users = page(users, [*order, ("user_id", False)], skipped, rows)
    return users.select(*fields) if fields else users


def _existing(cells, fields):
    """The ``fields`` that are stored features or qualifiers of some cell; no more rows are fetched."""
    other = [c for c in fields if c not in STORED_FEATURES and c != "user_id"]
    found = set()
    if other:
        qualifiers = cells.select(F.split_part("column", F.lit(":"), F.lit(2)).alias("qualifier"))
        found = {r.qualifier for r in qualifiers.filter(F.col("qualifier").isin(other)).distinct().collect()}
    return [c for c in dict.fromkeys(fields) if c in found or c in STORED_FEATURES and c != "user_id"]


def query_cells(
    cells,
    user_id=None,
    top_n=10,
    min_active_days=None,
    max_active_days=None,
    min_buy_ratio=None,
    max_buy_ratio=None,
    order_by=None,
    desc=False,
    fields=None,
    limit=None,
    offset=None,
):
    """Filter, sort, skip and limit on numbers, then fetch the text that is shown.

    In filters and the sort key a missing or unreadable value counts as 0. ``fields`` and
    ``order_by`` name any qualifiers. With ``fields``, the result has these, null where a key
    lacks them and left out if no key has them; without, a column ``cells`` maps every
    qualifier a key has to its value.
    """
    shown = _existing(cells, fields) if fields else None

    def show(found, keep=()):
        return decode_all(found, keep) if shown is None else decode_cells(found, shown, keep)

    if user_id is not None:
        return show(cells.filter(F.col("row_key") == str(user_id)))

    days, ratio = (min_active_days, max_active_days), (min_buy_ratio, max_buy_ratio)
    used = [order_by] if order_by and order_by != "user_id" else []
    used += ["active_days"] if days != (None, None) else []
    used += ["buy_ratio"] if ratio != (None, None) else []
    rows = decode_numbers(cells, list(dict.fromkeys(used)))

    def value_of(column):
        return f"coalesce({number('user_id') if column == 'user_id' else f'`{column}`'}, 0D)"

    for condition in _bounds(value_of, days, ratio):
        rows = rows.filter(condition)
    order = [("_key", desc)] if order_by else []
    keys = rows.select("user_id", *[F.expr(value_of(order_by)).alias("_key") for _ in order])
    keys = page(keys, [*order, ("user_id", False)], offset, limit if limit is not None else top_n)
    if shown == []:
        return keys.select("user_id")
    # A key is there once, so one join fetches the cells and the number to sort by.
    own = cells.join(keys.withColumnRenamed("user_id", "row_key"), "row_key")
    return (
        show(own, [name for name, _ in order])
        .orderBy(*sort_keys(order), "user_id")
        .drop("_key")
    )


def low_conversion_users(users, min_active_days, max_buy_ratio, **options):
    """Active users who rarely buy, most active first."""
    options = {"top_n": None, "order_by": "active_days", "desc": True, **options}
    return query_table(
        users, min_active_days=min_active_days, max_buy_ratio=max_buy_ratio, **options
    )


def high_intent_users(users, min_buy_ratio, **options):
    """Users who often buy, keenest first."""
    options = {"top_n": None, "order_by": "buy_ratio", "desc": True, **options}
    return query_table(users, min_buy_ratio=min_buy_ratio, **options)


def top_active_users(users, n=10):
    """The ``n`` users with the most active days, as drawn in the bar chart."""
    ranked = users.selectExpr("user_id", f"{number('active_days')} AS active_days")
    return (
        ranked.filter("active_days IS NOT NULL").orderBy(F.desc("active_days"), "user_id").limit(n)
    )


def verify_table(users, n=5):
    """Row count of the table beside its ``n`` most active users."""
    total = users.selectExpr("count(*) AS n").scalar()
    top = users.orderBy(F.desc("active_days"), "user_id").limit(n)
    return top.select(total.alias("total_rows"), "*")
