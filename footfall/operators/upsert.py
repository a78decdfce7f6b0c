"""Keyed upsert into the user table."""

from footfall.schema import STORED_FEATURES


def upsert_users(stored, batch, loaded_at=None):
    """The user table after loading ``batch`` (see ``stored_rows``).

    Users in the batch are inserted or replaced, others stay as they are, and
    ``created_at`` keeps the time a user was first loaded. Loading the same
    batch again changes nothing. ``stored`` is None for the first load;
    ``loaded_at`` is timestamp text, the present unless given.

    Both sides have one row per user, so the join keys cannot be skewed.
    """
    now = "current_timestamp()" if loaded_at is None else f"timestamp '{loaded_at}'"
    if stored is None:
        return batch.selectExpr("user_id", *STORED_FEATURES, f"{now} AS created_at")
    merged = stored.alias("old").join(batch.alias("new"), "user_id", "full_outer")
    return merged.selectExpr(
        "user_id",
        *[f"coalesce(new.{c}, old.{c}) AS {c}" for c in STORED_FEATURES],
        f"coalesce(old.created_at, {now}) AS created_at",
    )
