"""The thirteen named business queries."""

from marketlens.plans.marts import (  # noqa: F401
    best_sellers, cohort, customers_distribution, delay_review_correlation, delay_stats,
    delays_by_state, first_order_analysis, negative_reviews, network_delay,
    network_delay_pairs, person_months, cohort_spine, product_reviews, reviews, rmf_per_client,
    sales_by_category_month, stage_durations,
)
