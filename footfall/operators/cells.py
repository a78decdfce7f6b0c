"""User features as text cells: (row_key, ``family:qualifier``, value)."""

from pyspark.sql import functions as F

from footfall.functions.expressions import number
from footfall.schema import STORED_FEATURES

# The column family used unless another is named, and the layout
# of a cell table.
FAMILY = "f"
CELL_COLUMNS = ["row_key", "column", "value"]


def encode_cells(rows, family=FAMILY):
    """One text cell per stored feature, without a shuffle."""
    cells = ", ".join(
        f"struct('{family}:{c}' AS column, string({c}) AS value)" for c in STORED_FEATURES
    )
    return rows.selectExpr("string(user_id) AS row_key", f"inline(array({cells}))")


def merge_cells(stored, batch):
    """Cells after putting ``batch``: a cell is replaced when its row key and
    column are put again, and kept otherwise."""
    if stored is None:
        return batch.select(*CELL_COLUMNS)
    key = ["row_key", "column"]
    merged = stored.withColumnRenamed("value", "old").join(
        batch.withColumnRenamed("value", "new"), key, "full_outer"
    )
    return merged.selectExpr(*key, "coalesce(new, old) AS value")


def _latest(cells, condition, keep=()):
    """Per row key, the cells with the condition as (qualifier, value), one of each qualifier.

    Where families have the same qualifier, the one whose column comes last counts. Text
    cannot be kept in the fixed-width buffers of a hash aggregate, so the cells of a key are
    collected; a key has as many cells as columns. Keys without such a cell have none.
    """
    own = cells.selectExpr(
        "row_key AS user_id", *keep, "split_part(column, ':', 2) AS qualifier", "column", "value"
    )
    ordered = own.selectExpr(
        "user_id", *keep, f"if({condition}, struct(qualifier, column, value), NULL) AS cell"
    )
    last = "i + 1 = size(found) OR found[least(i + 1, size(found) - 1)].qualifier <> c.qualifier"
    return (
        ordered.groupBy("user_id", *keep)
        .agg(F.expr("sort_array(collect_set(cell)) AS found"))
        .selectExpr("user_id", *keep, f"filter(found, (c, i) -> {last}) AS found")
        .selectExpr("user_id", *keep, "transform(found, c -> struct(c.qualifier, c.value)) AS own")
        .selectExpr("user_id", *keep, "map_from_entries(own) AS own")
    )


def _text(name):
    """``name`` as an SQL literal."""
    escaped = name.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def decode_cells(cells, columns=None, keep=()):
    """One row per row key, all values text; a missing cell is null.

    ``columns`` are any qualifiers, the stored features unless given. Without any, the row
    keys. ``keep`` names columns that are the same in all cells of a key.
    """
    wanted = list(STORED_FEATURES) if columns is None else [c for c in columns if c != "user_id"]
    if not wanted:
        return cells.selectExpr("row_key AS user_id", *keep).distinct()
    names = ", ".join(map(_text, wanted))
    found = _latest(cells, f"qualifier IN ({names})", keep)
    return found.select("user_id", *keep, *[F.col("own")[c].alias(c) for c in wanted])


def decode_all(cells, keep=()):
    """One row per row key with a map of every qualifier it has to its text."""
    return _latest(cells, "true", keep).withColumnRenamed("own", "cells")


def decode_numbers(cells, columns):
    """``columns`` as doubles; a missing cell or text that is no number is null.

    ``user_id`` is the row key and stays text.
    """
    wanted = [c for c in columns if c != "user_id"]
    found = decode_cells(cells, wanted)
    return found.select("user_id", *[F.expr(number(f"`{c}`")).alias(c) for c in wanted])


def head_cells(cells, n=5):
    """All cells of the first ``n`` row keys; keys are text, so 10 precedes 2."""
    keys = cells.select("row_key").distinct().orderBy("row_key").limit(n)
    return cells.join(keys, "row_key", "left_semi")


def cell_row_count(cells):
    return cells.selectExpr("count(DISTINCT row_key) AS total_rows")
