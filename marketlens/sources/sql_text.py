"""SQL text in, DataFrame out (A4), with named parameters, over a marketplace's tables.

In the text, the nine tables are views and the thirteen named results are functions that
return tables, so one statement can read and combine them:

    SELECT churned, count(*) FROM rmf_per_client(:snapshot, :control) GROUP BY 1
    SELECT * FROM orders WHERE order_purchase_timestamp >= :since

Values are passed as parameters of the text (``:since``), never pasted into it.  Only what
a text mentions is planned and registered.  A function's body is inlined where it is
used: Catalyst pushes filters into it and prunes its columns like those of any view.
Names live in the session; ``prefix`` keeps several marketplaces apart.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession

from marketlens import plans
from marketlens.sources.marketplace import TABLES, Marketplace

# Results without parameters; each is a function without arguments.
RESULTS: dict[str, Callable[[Marketplace], DataFrame]] = {
    "best_sellers": plans.best_sellers, "reviews": plans.reviews,
    "customers_distribution": plans.customers_distribution, "delays_by_state": plans.delays_by_state,
    "sales_by_category_month": plans.sales_by_category_month, "delay_stats": plans.delay_stats,
    "network_delay": plans.network_delay, "delay_review_correlation": plans.delay_review_correlation,
    "negative_reviews": plans.negative_reviews, "product_reviews": plans.product_reviews,
    "cohort": plans.cohort, "first_order_analysis": plans.first_order_analysis,
}

# K11 with its two dates as arguments.  Payments and reviews are summed for each order
# before the joins; a row with both counts once for each pair of them.
RMF_PER_CLIENT = """
WITH paid AS (
  SELECT order_id, COUNT(*) AS n_pay, SUM(TRY_CAST(payment_value AS DECIMAL(38,12))) AS amount
  FROM {p}order_payments GROUP BY order_id),
rated AS (
  SELECT order_id, COUNT(*) AS n_rev, SUM(review_score) AS score_sum, COUNT(review_score) AS score_n
  FROM {p}order_reviews GROUP BY order_id),
facts AS (
  SELECT c.customer_unique_id, o.order_purchase_timestamp AS bought, n_pay * n_rev AS n_rows,
         amount * CAST(n_rev AS DECIMAL(20,0)) AS amount, score_sum * n_pay AS score_sum, score_n * n_pay AS score_n,
         CASE WHEN order_delivered_customer_date > order_estimated_delivery_date
              THEN EXTRACT(DAY FROM order_delivered_customer_date - order_estimated_delivery_date) ELSE 0 END
           * n_pay * n_rev AS late_days,
         o.order_purchase_timestamp <= snapshot AND n_pay IS NOT NULL AND n_rev IS NOT NULL AS counted,
         o.order_purchase_timestamp < control AS known
  FROM {p}orders o JOIN {p}customers c ON c.customer_id = o.customer_id
  LEFT JOIN paid ON paid.order_id = o.order_id LEFT JOIN rated ON rated.order_id = o.order_id
  WHERE o.order_purchase_timestamp < control OR o.order_purchase_timestamp <= snapshot),
persons AS (
  SELECT customer_unique_id, MAX(bought) FILTER (WHERE counted) AS last_counted,
         MAX(bought) FILTER (WHERE known) AS last_known, SUM(n_rows) FILTER (WHERE counted) AS frequency,
         CAST(SUM(amount) FILTER (WHERE counted) AS DECIMAL(38,12)) AS amount,
         SUM(score_sum) FILTER (WHERE counted) AS score_sum, SUM(score_n) FILTER (WHERE counted) AS score_n,
         SUM(late_days) FILTER (WHERE counted) AS late_days
  FROM facts GROUP BY customer_unique_id)
SELECT customer_unique_id, EXTRACT(DAY FROM snapshot - last_counted) AS recency, frequency,
       ROUND(CAST(amount AS DOUBLE), 8) AS monetary,
       CAST(score_sum AS DOUBLE) / NULLIF(score_n, 0) AS average_score,
       CAST(late_days AS DOUBLE) / NULLIF(frequency, 0) AS average_delay_days,
       CASE WHEN last_counted = last_known THEN 0 ELSE 1 END AS churned
FROM persons WHERE last_counted IS NOT NULL AND last_known IS NOT NULL
ORDER BY churned DESC
"""


class Catalogue:
    """A marketplace's tables and results, by name, for texts of a session."""

    def __init__(self, spark: SparkSession, m: Marketplace, prefix: str = ""):
        self.spark, self.m, self.prefix = spark, m, prefix
        self.views: set[str] = set()
        self.functions: set[str] = set()

    def _view(self, name: str, make: Callable[[], DataFrame]) -> None:
        if name not in self.views:
            make().createOrReplaceTempView(name)
            self.views.add(name)

    def _function(self, name: str, arguments: str, body: str) -> None:
        if name not in self.functions:
            self.spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({arguments}) RETURNS TABLE RETURN {body}")
            self.functions.add(name)

    def register(self, names: set[str]) -> None:
        """Views and functions of the given names; others are left alone."""
        p = self.prefix
        rmf = f"{p}rmf_per_client" in names
        for table in TABLES:
            if p + table in names or rmf and table in ("orders", "customers", "order_payments", "order_reviews"):
                self._view(p + table, lambda table=table: getattr(self.m, table))
        for name, plan in RESULTS.items():
            if p + name in names:
                self._view(f"{p}{name}_rows", lambda plan=plan: plan(self.m))
                self._function(p + name, "", f"SELECT * FROM {p}{name}_rows")
        if rmf:
            self._function(f"{p}rmf_per_client", "snapshot TIMESTAMP_NTZ, control TIMESTAMP_NTZ",
                           RMF_PER_CLIENT.format(p=p))

    def query(self, text: str, parameters: Mapping[str, object] | None = None) -> DataFrame:
        """A4: the text's result as a lazy DataFrame; ``:name`` takes ``parameters[name]``."""
        self.register(set(re.findall(r"\w+", text.lower())))
        return self.spark.sql(text, args=dict(parameters or {}))

    def drop(self) -> None:
        """Forget what was registered."""
        for name in self.functions:
            self.spark.sql(f"DROP TEMPORARY FUNCTION IF EXISTS {name}")
        for name in self.views:
            self.spark.catalog.dropTempView(name)
        self.functions.clear()
        self.views.clear()
