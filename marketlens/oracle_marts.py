"""DuckDB bodies of the thirteen business queries, each derived from what its result
says, not from a join over fan-out rows: per-order multiplicities, per-pair counts, month
numbers, ordered lists.  ``oracle.py`` puts the stand-in tables before them.

Money is summed in DECIMAL(38, 12) and rounded to eight places at the end.
"""

from __future__ import annotations

MONTHS = ("jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec")

DAY_US = 86_400_000_000  # microseconds of a day


def _us(later: str, earlier: str) -> str:
    return f"(epoch_us({later}) - epoch_us({earlier}))"


def _days(later: str, earlier: str) -> str:
    """Whole days between two timestamps, towards zero."""
    return f"CAST({_us(later, earlier)} // {DAY_US} AS INTEGER)"


def _money(amount: str) -> str:
    return f"CAST({amount} AS DECIMAL(38, 12))"


def _money_out(total: str) -> str:
    return f"round(CAST({total} AS DOUBLE), 8)"


# How often each order was sold by a seller, and what each order's reviews add up to.
_SOLD = """
sold AS (SELECT seller_id, order_id, COUNT(*) AS k FROM st_order_items GROUP BY seller_id, order_id),
opinion AS (
  SELECT order_id, COUNT(*) AS n, SUM(review_score) AS stars, COUNT(review_score) AS scored,
         SUM(CASE WHEN review_score IN (1, 2) THEN 1 ELSE 0 END) AS low
  FROM st_order_reviews GROUP BY order_id)"""

# K1: a seller's order counts k times the number of its reviews (once without any).
BEST_SELLERS = f""",{_SOLD},
weighed AS (
  SELECT s.seller_id, s.k * greatest(COALESCE(o.n, 0), 1) AS copies, s.k * o.stars AS stars, s.k * o.scored AS scored,
         s.k * COALESCE(o.low, 0) AS low,
         CASE WHEN t.order_delivered_customer_date > t.order_estimated_delivery_date
              THEN {_days("t.order_delivered_customer_date", "t.order_estimated_delivery_date")} END AS days_late
  FROM sold s LEFT JOIN opinion o ON o.order_id = s.order_id, st_orders t WHERE t.order_id = s.order_id),
totals AS (
  SELECT seller_id, CAST(SUM(copies) AS BIGINT) AS n_orders, COUNT(*) AS different,
         CAST(SUM(stars) AS DOUBLE) / nullif(SUM(scored), 0) AS average_score,
         CAST(SUM(low) AS DOUBLE) * 100.0 / CAST(SUM(copies) AS DOUBLE) AS perc_negative_reviews,
         CAST(SUM(CASE WHEN days_late IS NULL THEN 0 ELSE copies END) AS DOUBLE) * 100.0 / COUNT(*) AS perc_delays,
         CAST(SUM(copies * days_late) AS DOUBLE)
           / nullif(SUM(CASE WHEN days_late IS NULL THEN 0 ELSE copies END), 0) AS average_delay_days
  FROM weighed GROUP BY seller_id)
SELECT v.seller_id, v.seller_zip_code_prefix AS zip_code, v.seller_state AS state, v.seller_city AS city,
       p.geolocation_lat, p.geolocation_lng, w.n_orders, w.average_score, w.perc_negative_reviews,
       w.perc_delays, w.average_delay_days
FROM st_sellers v, totals w, st_geolocation p
WHERE w.seller_id = v.seller_id AND p.geolocation_zip_code_prefix = v.seller_zip_code_prefix
  AND w.average_score IS NOT NULL AND w.average_delay_days IS NOT NULL
  AND v.seller_state IS NOT NULL AND v.seller_city IS NOT NULL
  AND p.geolocation_lat IS NOT NULL AND p.geolocation_lng IS NOT NULL
"""

# K2: scores 3, 4, 5 are positive.
REVIEWS = """
SELECT review_comment_message, review_score, CAST(COALESCE(review_score, 0) > 2 AS INTEGER) AS is_positive
FROM st_order_reviews WHERE review_comment_message IS NOT NULL
"""

# K3: what each order cost, added over the orders of a person and place.
CUSTOMERS_DISTRIBUTION = f""",
bill AS (SELECT order_id, SUM({_money("price + freight_value")}) AS total FROM st_order_items GROUP BY order_id),
spent AS (
  SELECT o.customer_id, SUM(b.total) AS total FROM bill b, st_orders o WHERE o.order_id = b.order_id GROUP BY o.customer_id)
SELECT c.customer_unique_id, c.customer_zip_code_prefix, c.customer_city, c.customer_state,
       p.geolocation_lat AS lat, p.geolocation_lng AS lng, {_money_out("SUM(s.total)")} AS spesa_totale
FROM spent s, st_customers c, st_geolocation p
WHERE c.customer_id = s.customer_id AND p.geolocation_zip_code_prefix = c.customer_zip_code_prefix
GROUP BY ALL
"""

# K4: items by state and by whether their order came late; exact half-up rounding.
DELAYS_BY_STATE = """,
late_orders AS (
  SELECT order_id, CASE WHEN order_delivered_customer_date > order_estimated_delivery_date THEN 1 ELSE 0 END AS late
  FROM st_orders),
by_state AS (
  SELECT (SELECT v.seller_state FROM st_sellers v WHERE v.seller_id = i.seller_id) AS seller_state, l.late, COUNT(*) AS n
  FROM st_order_items i, late_orders l
  WHERE l.order_id = i.order_id AND i.seller_id IN (SELECT seller_id FROM st_sellers) GROUP BY ALL),
counts AS (
  SELECT seller_state, CAST(SUM(n * late) AS BIGINT) AS number_of_delays, CAST(SUM(n) AS BIGINT) AS number_of_orders
  FROM by_state GROUP BY seller_state)
SELECT *, CAST((20000 * CAST(number_of_delays AS HUGEINT) + number_of_orders) // (2 * number_of_orders) AS DOUBLE) / 100
          AS percentage_of_delays
FROM counts
"""

# K5: a count for each category and month number, spread over twelve columns.
_SOLD_IN = ", ".join(f"CAST(COALESCE(months[{k + 1}], 0) AS BIGINT) AS sold_in_{m}" for k, m in enumerate(MONTHS))
SALES_BY_CATEGORY_MONTH = f""",
english AS (
  SELECT p.product_id, c.product_category_name_english AS category FROM st_products p, st_prodcategory c
  WHERE c.product_category_name = p.product_category_name),
monthly AS (
  SELECT e.category, month(o.order_purchase_timestamp) AS m, COUNT(*) AS n
  FROM st_order_items i, english e, st_orders o WHERE e.product_id = i.product_id AND o.order_id = i.order_id GROUP BY ALL),
spread AS (
  SELECT category, map_from_entries(list({{'k': m, 'v': n}}) FILTER (WHERE m IS NOT NULL)) AS months, SUM(n) AS total
  FROM monthly GROUP BY category)
SELECT category, {_SOLD_IN}, CAST(total AS BIGINT) AS total_sold FROM spread
"""

# K6: an order weighs as many times as the seller has items in it.
def _mean(later: str, earlier: str, name: str) -> str:
    us = _us(later, earlier)
    return f"CAST(SUM(k * {us}) AS DOUBLE) / SUM(CASE WHEN {us} IS NULL THEN 0 ELSE k END) / 1e6 AS {name}"


DELAY_STATS = f""",{_SOLD}
SELECT s.seller_id,
       CAST(SUM(CASE WHEN o.order_delivered_customer_date > o.order_estimated_delivery_date THEN k ELSE 0 END) AS BIGINT)
         AS number_of_delays,
       CAST(SUM(k) AS BIGINT) AS total_orders,
       {_mean("o.order_approved_at", "o.order_purchase_timestamp", "avg_seller_response_time_seconds")},
       {_mean("o.order_delivered_carrier_date", "o.order_approved_at", "carrier_delivery_time_seconds")},
       {_mean("o.order_delivered_customer_date", "o.order_delivered_carrier_date", "customer_delivery_time_seconds")}
FROM sold s, st_orders o
WHERE o.order_id = s.order_id
  AND date_part('day', o.order_delivered_customer_date) > date_part('day', o.order_estimated_delivery_date)
GROUP BY s.seller_id
"""

# K7: a pair's n items repeat its row n times n times: two generated series.
_PAIRS = """,
pair AS (
  SELECT i.seller_id, o.customer_id, COUNT(*) AS n FROM st_order_items i, st_orders o
  WHERE o.order_id = i.order_id
    AND date_part('day', o.order_delivered_customer_date) > date_part('day', o.order_estimated_delivery_date)
  GROUP BY i.seller_id, o.customer_id),
placed AS (
  SELECT p.seller_id, v.seller_city, v.seller_state, a.geolocation_lat AS seller_lat, a.geolocation_lng AS seller_lng,
         p.customer_id, c.customer_city, c.customer_state, b.geolocation_lat AS customer_lat,
         b.geolocation_lng AS customer_lng, p.n AS n_items
  FROM pair p, st_sellers v, st_customers c, st_geolocation a, st_geolocation b
  WHERE v.seller_id = p.seller_id AND c.customer_id = p.customer_id
    AND a.geolocation_zip_code_prefix = v.seller_zip_code_prefix
    AND b.geolocation_zip_code_prefix = c.customer_zip_code_prefix)"""
NETWORK_DELAY = _PAIRS + """
SELECT * EXCLUDE (n_items) FROM (
  SELECT * EXCLUDE (again) FROM (SELECT *, unnest(range(n_items * n_items)) AS again FROM placed))
"""
NETWORK_DELAY_PAIRS = _PAIRS + """
SELECT *, n_items * n_items AS n_rows FROM placed
"""

# K8
DELAY_REVIEW_CORRELATION = f"""
SELECT r.order_id, {_days("o.order_delivered_customer_date", "o.order_estimated_delivery_date")} AS delivery_delay,
       r.review_score
FROM st_order_reviews r, st_orders o
WHERE r.order_id = o.order_id AND r.review_score IS NOT NULL
  AND {_us("o.order_delivered_customer_date", "o.order_estimated_delivery_date")} IS NOT NULL
"""

# K9: scores below three, with a text.
NEGATIVE_REVIEWS = """
SELECT review_comment_message, review_score FROM st_order_reviews
WHERE review_score < 3 AND review_comment_message IS NOT NULL
"""

# An order's scores weigh as many times as the product is in it.
PRODUCT_REVIEWS = """,
stars AS (
  SELECT order_id, SUM(review_score) AS total, COUNT(*) AS n FROM st_order_reviews
  WHERE review_score IS NOT NULL GROUP BY order_id),
bought AS (SELECT product_id, order_id, COUNT(*) AS k FROM st_order_items GROUP BY product_id, order_id),
per_product AS (
  SELECT b.product_id, CAST(SUM(b.k * s.total) AS DOUBLE) / SUM(b.k * s.n) AS avg_score
  FROM bought b, stars s WHERE s.order_id = b.order_id GROUP BY b.product_id)
SELECT x.product_id, c.product_category_name_english, x.avg_score
FROM per_product x, st_products p, st_prodcategory c
WHERE p.product_id = x.product_id AND c.product_category_name = p.product_category_name
"""


def rmf_body(snapshot: str, control: str) -> str:
    """Two lists of orders for each person, compared: those before the control date,
    and those up to the snapshot that were paid and reviewed."""
    return f""",
paid AS (SELECT order_id, COUNT(*) AS n, SUM({_money("payment_value")}) AS total FROM st_order_payments GROUP BY order_id),
rated AS (
  SELECT order_id, COUNT(*) AS n, SUM(review_score) AS stars, COUNT(review_score) AS scored
  FROM st_order_reviews GROUP BY order_id),
bought AS (
  SELECT c.customer_unique_id AS person, o.order_id, o.order_purchase_timestamp AS bought_on,
         greatest(COALESCE({_days("o.order_delivered_customer_date", "o.order_estimated_delivery_date")}, 0), 0) AS late
  FROM st_orders o, st_customers c WHERE c.customer_id = o.customer_id),
up_to_control AS (SELECT person, MAX(bought_on) AS last FROM bought WHERE bought_on < TIMESTAMP '{control}' GROUP BY person),
up_to_snapshot AS (
  SELECT b.person, MAX(b.bought_on) AS last, SUM(p.n * r.n) AS copies, SUM(p.total * r.n) AS money,
         SUM(r.stars * p.n) AS stars, SUM(r.scored * p.n) AS scored, SUM(b.late * p.n * r.n) AS late
  FROM bought b, paid p, rated r
  WHERE p.order_id = b.order_id AND r.order_id = b.order_id AND b.bought_on <= TIMESTAMP '{snapshot}' GROUP BY b.person)
SELECT s.person AS customer_unique_id, {_days(f"TIMESTAMP '{snapshot}'", "s.last")} AS recency,
       CAST(s.copies AS BIGINT) AS frequency, {_money_out("s.money")} AS monetary,
       CAST(s.stars AS DOUBLE) / nullif(s.scored, 0) AS average_score,
       CAST(s.late AS DOUBLE) / s.copies AS average_delay_days,
       CAST(s.last IS DISTINCT FROM c.last AS INTEGER) AS churned
FROM up_to_snapshot s, up_to_control c WHERE c.person IS NOT DISTINCT FROM s.person
"""


# Months as numbers; a person's activity are the differences to the first one.
_ACTIVITY = """,
active AS (
  SELECT DISTINCT c.customer_unique_id AS person,
         12 * year(o.order_purchase_timestamp) + month(o.order_purchase_timestamp) - 1 AS m
  FROM st_orders o, st_customers c WHERE c.customer_id = o.customer_id AND o.order_purchase_timestamp IS NOT NULL),
person AS (SELECT person, MIN(m) AS first, list(m) AS months FROM active GROUP BY person),
every_month AS (
  SELECT unnest(range(lo, hi + 1)) AS m FROM (SELECT MIN(first) AS lo, MAX(first) AS hi FROM person) WHERE lo IS NOT NULL)"""
_STILL = ", ".join(f"CAST(COALESCE(SUM(CASE WHEN d = {k} THEN n END), 0) AS BIGINT) AS still_active_{k}m"
                   for k in range(1, 13))
COHORT = _ACTIVITY + f""",
differences AS (
  SELECT first, d, COUNT(*) AS n FROM (SELECT first, unnest(months) - first AS d FROM person) GROUP BY first, d)
SELECT make_date(e.m // 12, e.m % 12 + 1, 1) AS purchase_month,
       CAST(COALESCE(SUM(CASE WHEN d = 0 THEN n END), 0) AS BIGINT) AS new_clients, {_STILL}
FROM every_month e LEFT JOIN differences x ON x.first = e.m GROUP BY e.m ORDER BY e.m
"""
MONTH_SPINE = _ACTIVITY + """
SELECT make_date(m // 12, m % 12 + 1, 1) AS calendar_month FROM every_month
"""


# Each person's orders as a list in time order; an order's first item, review and
# payment as the first of its own list.
def _first_of(table: str, name: str, columns: tuple[str, ...]) -> str:
    order = ", ".join(f"{c} ASC NULLS FIRST" for c in columns)
    row = ", ".join(f"'{c}': {c}" for c in columns)
    return f"{name} AS (SELECT order_id, COUNT(*) AS n, first({{{row}}} ORDER BY {order}) AS f FROM {table} GROUP BY order_id)"


FIRST_ORDER_ANALYSIS = f""",
{_first_of("st_order_items", "item", ("order_item_id", "product_id", "seller_id", "price", "freight_value"))},
{_first_of("st_order_reviews", "review", ("review_id", "review_score"))},
{_first_of("st_order_payments", "payment",
           ("payment_sequential", "payment_installments", "payment_type", "payment_value"))},
history AS (
  SELECT c.customer_unique_id AS person,
         list({{'id': o.order_id, 'at': o.order_purchase_timestamp, 'state': c.customer_state,
                'late': {_days("o.order_delivered_customer_date", "o.order_estimated_delivery_date")}}}
              ORDER BY o.order_purchase_timestamp ASC NULLS LAST, o.order_id) AS h
  FROM st_orders o, st_customers c WHERE c.customer_id = o.customer_id GROUP BY c.customer_unique_id)
SELECT x.person AS customer_unique_id, greatest(COALESCE(h[1].late, 0), 0) AS delay, r.f.review_score AS review_score,
       (SELECT p.product_category_name FROM st_products p WHERE p.product_id = i.f.product_id) AS product_category_name,
       i.f.freight_value / nullif(i.f.price, 0) AS delivery_cost_percentage,
       y.f.payment_installments AS payment_installments,
       CAST(COALESCE(h[1].state <> (SELECT v.seller_state FROM st_sellers v WHERE v.seller_id = i.f.seller_id), FALSE)
            AS INTEGER) AS interstate_shipping,
       CAST(CASE WHEN COALESCE(i.n, 1) * COALESCE(r.n, 1) * COALESCE(y.n, 1) > 1 THEN h[1].at IS NOT NULL
                 ELSE COALESCE(epoch_us(h[2].at) - epoch_us(h[1].at) < 90 * {DAY_US}, FALSE) END AS INTEGER)
         AS came_back_in_3_months
FROM history x LEFT JOIN item i ON i.order_id = h[1].id LEFT JOIN review r ON r.order_id = h[1].id
     LEFT JOIN payment y ON y.order_id = h[1].id
ORDER BY customer_unique_id
"""
