"""The table behind each figure of the report, by file name."""

from footfall.functions.expressions import numeric_rows
from footfall.operators import distributions as d
from footfall.plans.feature_query import top_active_users

# Columns compared pairwise.
PAIR_COLUMNS = ["active_days", "item_category_count", "buy_ratio", "cart2buy_rate"]


def active_days_density(users):
    return d.density(d.as_series(users, ["active_days"]))


def buy_ratio_density(users):
    return d.density(d.as_series(users, ["buy_ratio"]))


def pair_densities(users):
    """Diagonal of the pair matrix, drawn three bandwidths past the data."""
    return d.density(d.as_series(users, PAIR_COLUMNS), cut=3.0)


def figure_tables(users, top_n=10):
    """``users`` holds user_id and the charted columns, as numbers or text."""
    return {
        "active_days_distribution": d.integer_histogram(users, "active_days"),
        "active_days_density": active_days_density(users),
        "buy_ratio_distribution": d.equal_width_histogram(users, "buy_ratio", 20),
        "buy_ratio_density": buy_ratio_density(users),
        "active_level": d.activity_levels(users),
        "top_active_users": top_active_users(users, top_n),
        "active_days_vs_buy_ratio_box": d.box_stats(users, "buy_ratio"),
        "active_days_vs_buy_ratio_outliers": d.box_outliers(users, "buy_ratio"),
        "active_days_vs_category": d.scatter(users, "active_days", "item_category_count"),
        "active_days_vs_buy_ratio_violin": d.violin_densities(users, "buy_ratio"),
        "active_days_vs_category_heatmap": d.crosstab(users, "active_days", "item_category_count"),
        "buy_ratio_ecdf": d.cumulative_shares(users, "buy_ratio"),
        "pair_rows": numeric_rows(users, PAIR_COLUMNS),
        "pair_densities": pair_densities(users),
    }
