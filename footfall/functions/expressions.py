"""SQL expressions used by more than one operator."""

import datetime


def day_literal(as_of):
    """The day recency is measured from: a date, ``yyyy-MM-dd`` text or today."""
    if as_of is None:
        return "current_date()"
    day = as_of if isinstance(as_of, datetime.date) else datetime.date.fromisoformat(as_of)
    return f"DATE '{day:%Y-%m-%d}'"


def number(column):
    """Text or number as a double; text that is no number becomes null."""
    return f"try_cast({column} AS double)"


def numeric_rows(df, columns, keep=()):
    """``columns`` as doubles, rows complete in all of them; ``keep`` rides along."""
    cast = df.selectExpr(*keep, *[f"{number(c)} AS {c}" for c in columns])
    return cast.filter(" AND ".join(f"{c} IS NOT NULL AND NOT isnan({c})" for c in columns))


# Activity levels as (label, lowest day count, exists above max).
# A level exists only when the largest day count in the data exceeds its third
# field, and the highest existing level is open-ended.
ACTIVITY_LEVELS = [
    ("0d", 0, -1),
    ("1-7d", 1, 1),
    ("8-30d", 7, 7),
    ("31-90d", 30, 30),
    ("91-365d", 90, 90),
    (">365d", 365, 365),
]


def activity_level(days, largest):
    """Label of a day count, given the largest day count in the data."""
    cases = [
        f"WHEN {days} >= {lowest} AND {largest} > {above} THEN '{label}'"
        for label, lowest, above in reversed(ACTIVITY_LEVELS)
    ]
    return f"CASE {' '.join(cases)} END"


# Segment names by active days; anything else is the last.
USER_SEGMENT = """
    CASE WHEN active_days = 1 THEN '单日用户'
         WHEN active_days BETWEEN 2 AND 4 THEN '低频用户'
         WHEN active_days BETWEEN 5 AND 9 THEN '中频用户'
         ELSE '高频用户' END"""
