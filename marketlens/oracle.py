"""DuckDB SQL equal to each registered query, over the driver's parquet views.

Every statement starts with the stand-in tables as CTEs (FIXTURES.md section 4); the
business queries' bodies are in ``oracle_marts``.  Type casts only align result types
between the engines (DuckDB widens sums to HUGEINT and EXTRACT to BIGINT).
"""

from __future__ import annotations

from marketlens import oracle_marts as marts

BASE_CTES = """
st_orders AS (
  SELECT o_orderkey AS order_id, o_orderkey AS customer_id, o_orderstatus AS order_status,
         o_orderdate AS order_purchase_timestamp,
         CASE WHEN o_orderkey % 40 = 3 THEN NULL
              ELSE o_orderdate + INTERVAL '1' HOUR * CAST(o_orderkey % 72 AS INT) END AS order_approved_at,
         CASE WHEN o_orderkey % 25 = 4 THEN NULL
              ELSE o_orderdate + INTERVAL '1' HOUR * CAST(72 + (o_orderkey * 7) % 240 AS INT) END AS order_delivered_carrier_date,
         CASE WHEN o_orderkey % 25 = 4 THEN NULL
              ELSE o_orderdate + INTERVAL '1' HOUR * CAST(312 + (o_orderkey * 13) % 480 AS INT) END AS order_delivered_customer_date,
         o_orderdate + INTERVAL '1' DAY * CAST(20 + o_orderkey % 9 AS INT) AS order_estimated_delivery_date
  FROM orders),
st_customers AS (
  SELECT o.o_orderkey AS customer_id, o.o_custkey AS customer_unique_id,
         CAST(c.c_nationkey AS VARCHAR) || CASE WHEN o.o_custkey % 50 = 7 THEN 'F' ELSE '' END
           AS customer_zip_code_prefix,
         n.n_name AS customer_city, r.r_name AS customer_state
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey),
st_sellers AS (
  SELECT s.s_suppkey AS seller_id, CAST(s.s_nationkey AS VARCHAR) AS seller_zip_code_prefix,
         n.n_name AS seller_city, r.r_name AS seller_state
  FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey),
st_geolocation_raw AS (
  SELECT c_custkey AS input_pos, CAST(c_nationkey AS VARCHAR) AS geolocation_zip_code_prefix,
         CAST(c_custkey % 180 - 90 AS DOUBLE) AS geolocation_lat,
         CAST(c_custkey % 360 - 180 AS DOUBLE) AS geolocation_lng,
         'CITY_' || CAST(c_nationkey AS VARCHAR) AS geolocation_city,
         c_mktsegment AS geolocation_state
  FROM customer WHERE c_nationkey % 5 <> 0),
st_order_items AS (
  SELECT l_orderkey AS order_id, l_linenumber AS order_item_id, l_partkey AS product_id,
         l_suppkey AS seller_id, l_shipdate AS shipping_limit_date,
         CASE WHEN l_quantity = 1 THEN 0.0 ELSE l_extendedprice END AS price,
         l_extendedprice * l_tax AS freight_value
  FROM lineitem),
st_products AS (
  SELECT p_partkey AS product_id,
         CASE WHEN p_brand = 'Brand#7' THEN NULL ELSE p_type END AS product_category_name,
         p_size AS product_photos_qty, p_retailprice AS product_weight_g
  FROM part),
st_prodcategory_raw AS (
  SELECT DISTINCT p_type AS product_category_name, lower(p_type) AS product_category_name_english
  FROM part WHERE p_type <> 'PROMO'),
st_order_payments AS (
  SELECT CAST(floor(event_id / 2) AS BIGINT) AS order_id,
         CAST(event_id % 2 + 1 AS INTEGER) AS payment_sequential, event_type AS payment_type,
         CAST(event_id % 10 + 1 AS INTEGER) AS payment_installments, value AS payment_value
  FROM events),
st_order_reviews AS (
  SELECT e.event_id AS review_id,
         CASE WHEN e.event_id % 20 = 0 THEN e.event_id + 1 ELSE e.event_id END AS order_id,
         CASE WHEN e.event_id % 50 = 7 THEN NULL ELSE CAST((e.event_id * 7) % 5 + 1 AS INTEGER) END AS review_score,
         d.text AS review_comment_message, e.ts AS review_creation_date
  FROM events e LEFT JOIN documents d ON d.doc_id = e.event_id),
"""

# Load-time repair of geolocation and categories, over the st_* base tables.
REPAIR_CTES = """st_geo_first AS (
  SELECT geolocation_zip_code_prefix, geolocation_lat, geolocation_lng, geolocation_city, geolocation_state
  FROM (SELECT *, row_number() OVER (PARTITION BY geolocation_zip_code_prefix ORDER BY input_pos) AS rn
        FROM st_geolocation_raw) WHERE rn = 1),
st_geo_seller_add AS (
  SELECT seller_zip_code_prefix AS geolocation_zip_code_prefix, seller_city AS geolocation_city,
         seller_state AS geolocation_state, min(seller_id) AS pos
  FROM st_sellers s
  WHERE s.seller_zip_code_prefix IS NOT NULL AND NOT EXISTS (
        SELECT 1 FROM st_geo_first g WHERE g.geolocation_zip_code_prefix = s.seller_zip_code_prefix)
  GROUP BY 1, 2, 3),
st_geo_customer_add AS (
  SELECT customer_zip_code_prefix AS geolocation_zip_code_prefix, customer_city AS geolocation_city,
         customer_state AS geolocation_state, min(customer_id) AS pos
  FROM st_customers c
  WHERE c.customer_zip_code_prefix IS NOT NULL
    AND NOT EXISTS (SELECT 1 FROM st_geo_first g WHERE g.geolocation_zip_code_prefix = c.customer_zip_code_prefix)
    AND NOT EXISTS (SELECT 1 FROM st_geo_seller_add g WHERE g.geolocation_zip_code_prefix = c.customer_zip_code_prefix)
  GROUP BY 1, 2, 3),
st_geolocation AS (
  SELECT geolocation_zip_code_prefix, geolocation_lat, geolocation_lng, geolocation_city, geolocation_state
  FROM (SELECT *, row_number() OVER (PARTITION BY geolocation_zip_code_prefix
                                     ORDER BY prio, pos, geolocation_city, geolocation_state) AS rn
        FROM (SELECT *, 0 AS prio, 0 AS pos FROM st_geo_first
              UNION ALL SELECT geolocation_zip_code_prefix, 0.0, 0.0, geolocation_city, geolocation_state, 1, pos FROM st_geo_seller_add
              UNION ALL SELECT geolocation_zip_code_prefix, 0.0, 0.0, geolocation_city, geolocation_state, 2, pos FROM st_geo_customer_add))
  WHERE rn = 1),
st_category_add AS (
  SELECT DISTINCT p.product_category_name, 'Unknown' AS product_category_name_english
  FROM st_products p
  WHERE p.product_category_name IS NOT NULL AND NOT EXISTS (
        SELECT 1 FROM st_prodcategory_raw c WHERE c.product_category_name = p.product_category_name)),
st_prodcategory AS (
  SELECT product_category_name, product_category_name_english
  FROM (SELECT *, row_number() OVER (PARTITION BY product_category_name
                                     ORDER BY prio, product_category_name_english) AS rn
        FROM (SELECT *, 0 AS prio FROM st_prodcategory_raw
              UNION ALL SELECT *, 1 AS prio FROM st_category_add))
  WHERE rn = 1 AND product_category_name IS NOT NULL AND product_category_name_english IS NOT NULL)
"""

STANDIN_CTES = BASE_CTES + REPAIR_CTES



def without_base_tables(sql: str) -> str:
    """The same statement reading the ``st_*`` base tables as existing views (for
    running the oracle on other data); the repair CTEs stay."""
    return sql.replace("WITH " + BASE_CTES.lstrip(), "WITH ", 1)


def with_standins(body: str) -> str:
    """Prefix a statement (which may start with its own ``WITH``-less CTE list
    fragment ``name AS (...), ...`` followed by SELECT) with the stand-in CTEs."""
    return "WITH " + STANDIN_CTES.strip() + "\n" + body


def rmf_sql(snapshot: str = "2000-01-01", control: str = "2000-07-01") -> str:
    return with_standins(marts.rmf_body(snapshot, control))


from marketlens.sources.schemas import FOREIGN_KEYS, LOAD_ORDER, MAX_LENGTHS, PRIMARY_KEYS  # noqa: E402

STANDIN_TABLES = {
    "geolocation": "st_geolocation", "customers": "st_customers", "orders": "st_orders",
    "sellers": "st_sellers", "prodcategory": "st_prodcategory", "products": "st_products",
    "order_items": "st_order_items", "order_payments": "st_order_payments",
    "order_reviews": "st_order_reviews",
}
# Text columns of the stand-ins (ids are integers there, so no length rule applies).
STANDIN_TEXT_COLUMNS = {
    "geolocation": ("geolocation_zip_code_prefix", "geolocation_city", "geolocation_state"),
    "customers": ("customer_zip_code_prefix", "customer_city", "customer_state"),
    "orders": ("order_status",),
    "sellers": ("seller_zip_code_prefix", "seller_city", "seller_state"),
    "prodcategory": ("product_category_name", "product_category_name_english"),
    "products": ("product_category_name",),
    "order_payments": ("payment_type",),
    "order_reviews": ("review_comment_message",),
}


def _pk_body() -> str:
    parts = []
    for t, keys in PRIMARY_KEYS.items():
        k = ", ".join(keys)
        null = " OR ".join(f"{c} IS NULL" for c in keys)
        parts.append(f"""SELECT '{t}' AS table_name,
       COUNT(*) FILTER (WHERE n > 1 AND NOT null_key) AS n_duplicate_keys,
       CAST(COALESCE(SUM(n) FILTER (WHERE n > 1 AND NOT null_key), 0) AS BIGINT) AS n_duplicate_rows,
       CAST(COALESCE(SUM(n) FILTER (WHERE null_key), 0) AS BIGINT) AS n_null_key_rows
FROM (SELECT {k}, COUNT(*) AS n, bool_or({null}) AS null_key FROM {STANDIN_TABLES[t]} GROUP BY {k})""")
    return "\nUNION ALL\n".join(parts)


def _pk_sql() -> str:
    return with_standins(_pk_body())


def _fk_body() -> str:
    parts = []
    for child, col, parent, pcol in FOREIGN_KEYS:
        parts.append(f"""SELECT '{child}' AS child_table, '{col}' AS child_column, '{parent}' AS parent_table,
       CAST(COUNT(*) AS BIGINT) AS n_orphan_rows, COUNT(DISTINCT c.{col}) AS n_orphan_keys
FROM {STANDIN_TABLES[child]} c
WHERE c.{col} IS NOT NULL AND NOT EXISTS (SELECT 1 FROM {STANDIN_TABLES[parent]} p WHERE p.{pcol} = c.{col})""")
    return "\nUNION ALL\n".join(parts)


def _fk_sql() -> str:
    return with_standins(_fk_body())


def _length_body() -> str:
    parts = []
    for t, cols in STANDIN_TEXT_COLUMNS.items():
        for c in cols:
            n = MAX_LENGTHS[t][c]
            parts.append(f"""SELECT '{t}' AS table_name, '{c}' AS column_name, {n} AS max_length,
       COUNT(*) FILTER (WHERE length({c}) > {n}) AS n_violations,
       CAST(MAX(length({c})) AS INTEGER) AS longest
FROM {STANDIN_TABLES[t]}""")
    return "\nUNION ALL\n".join(parts)


def _length_sql() -> str:
    return with_standins(_length_body())


def _load_report_body() -> str:
    return f"""WITH
pk AS ({_pk_body()}),
fk AS ({_fk_body()}),
ln AS ({_length_body()}),
fk_t AS (SELECT child_table AS table_name, CAST(SUM(n_orphan_rows) AS BIGINT) AS fk FROM fk GROUP BY 1),
ln_t AS (SELECT table_name, CAST(SUM(n_violations) AS BIGINT) AS len FROM ln GROUP BY 1)
SELECT pk.table_name, pk.n_duplicate_rows + pk.n_null_key_rows AS pk,
       COALESCE(fk_t.fk, 0) AS fk, COALESCE(ln_t.len, 0) AS len,
       (pk.n_duplicate_rows + pk.n_null_key_rows + COALESCE(fk_t.fk, 0) + COALESCE(ln_t.len, 0)) = 0 AS loadable
FROM pk LEFT JOIN fk_t USING (table_name) LEFT JOIN ln_t USING (table_name)"""


def _load_report_sql() -> str:
    return with_standins(f"SELECT * FROM ({_load_report_body()})")


GEOLOCATION_DEDUP_FIRST = with_standins("SELECT * FROM st_geo_first")
ORPHAN_SELLER_ZIPS = with_standins(
    "SELECT geolocation_zip_code_prefix, geolocation_city, geolocation_state FROM st_geo_seller_add")
ORPHAN_CUSTOMER_ZIPS = with_standins(
    "SELECT geolocation_zip_code_prefix, geolocation_city, geolocation_state FROM st_geo_customer_add")
ORPHAN_CATEGORIES = with_standins("SELECT product_category_name FROM st_category_add")
GEOLOCATION_REPAIRED = with_standins("SELECT * FROM st_geolocation")
CATEGORY_REPAIRED = with_standins("SELECT * FROM st_prodcategory")

STAGE_DURATIONS = with_standins("""
SELECT order_id,
       (epoch_us(order_approved_at) - epoch_us(order_purchase_timestamp)) / 1e6 AS seller_response_seconds,
       (epoch_us(order_delivered_carrier_date) - epoch_us(order_approved_at)) / 1e6 AS carrier_seconds,
       (epoch_us(order_delivered_customer_date) - epoch_us(order_delivered_carrier_date)) / 1e6 AS customer_delivery_seconds,
       CAST(EXTRACT(DAY FROM order_delivered_customer_date - order_estimated_delivery_date) AS INTEGER) AS delivery_delay_days
FROM st_orders
""")

ORACLE: dict[str, str] = {
    "geolocation_dedup_first": GEOLOCATION_DEDUP_FIRST,
    "orphan_seller_zips": ORPHAN_SELLER_ZIPS,
    "orphan_customer_zips": ORPHAN_CUSTOMER_ZIPS,
    "orphan_categories": ORPHAN_CATEGORIES,
    "geolocation_repaired": GEOLOCATION_REPAIRED,
    "category_repaired": CATEGORY_REPAIRED,
    "pk_violations": _pk_sql(),
    "fk_violations": _fk_sql(),
    "length_violations": _length_sql(),
    "load_report": _load_report_sql(),
    "month_spine": with_standins(marts.MONTH_SPINE),
    "stage_durations": STAGE_DURATIONS,
    "best_sellers": with_standins(marts.BEST_SELLERS),
    "reviews": with_standins(marts.REVIEWS),
    "customers_distribution": with_standins(marts.CUSTOMERS_DISTRIBUTION),
    "delays_by_state": with_standins(marts.DELAYS_BY_STATE),
    "sales_by_category_month": with_standins(marts.SALES_BY_CATEGORY_MONTH),
    "delay_stats": with_standins(marts.DELAY_STATS),
    "network_delay": with_standins(marts.NETWORK_DELAY),
    "network_delay_pairs": with_standins(marts.NETWORK_DELAY_PAIRS),
    "delay_review_correlation": with_standins(marts.DELAY_REVIEW_CORRELATION),
    "negative_reviews": with_standins(marts.NEGATIVE_REVIEWS),
    "product_reviews": with_standins(marts.PRODUCT_REVIEWS),
    "rmf_per_client": rmf_sql(),
    "cohort": with_standins(marts.COHORT),
    "first_order_analysis": with_standins(marts.FIRST_ORDER_ANALYSIS),
}


# ---------------------------------------------------------------- text pipeline
def _text_ctes() -> str:
    from marketlens.functions.text import HTML_TAG, NOT_KEPT, WHITESPACE_RUN, default_stopwords

    words = ", ".join("'" + w.replace("'", "''") + "'" for w in default_stopwords("portuguese"))
    return f""",
corpus AS (
  SELECT review_id AS doc_id, review_comment_message AS text,
         CASE WHEN review_score >= 3 THEN 1 ELSE 0 END AS label
  FROM st_order_reviews WHERE review_comment_message IS NOT NULL),
cleaned AS (
  SELECT doc_id, label,
         list_filter(list_filter(
             string_split_regex(regexp_replace(regexp_replace(lower(coalesce(text, '')), '{HTML_TAG}', '', 'g'),
                                               '{NOT_KEPT}', '', 'g'), '{WHITESPACE_RUN}'),
             lambda x: x <> ''), lambda x: NOT list_contains([{words}], x)) AS tokens
  FROM corpus),
split AS (
  SELECT doc_id,
         CASE WHEN CAST(('0x' || substr(md5(CAST(doc_id AS VARCHAR) || ':42'), 1, 8)) AS BIGINT) % 100 < 20
              THEN 'test' ELSE 'train' END AS split,
         CAST(('0x' || substr(md5(CAST(doc_id AS VARCHAR) || ':42'), 1, 8)) AS BIGINT) AS h
  FROM corpus),
doc_terms AS (
  SELECT c.doc_id, c.label, s.split, list_filter(c.tokens, lambda x: length(x) >= 2) AS terms
  FROM cleaned c JOIN split s USING (doc_id)),
tf AS (
  SELECT doc_id, split, term, COUNT(*) AS tf
  FROM (SELECT doc_id, split, unnest(terms) AS term FROM doc_terms) GROUP BY ALL),
top_terms AS (
  SELECT term, SUM(tf) AS total_count, COUNT(*) AS doc_freq
  FROM tf WHERE split = 'train' GROUP BY term
  ORDER BY total_count DESC, term ASC LIMIT 5000),
vocab AS (
  SELECT term, CAST(row_number() OVER (ORDER BY term) - 1 AS INTEGER) AS term_index,
         CAST(total_count AS BIGINT) AS total_count, doc_freq,
         ln((1.0 + CAST(n AS DOUBLE)) / (1.0 + CAST(doc_freq AS DOUBLE))) + 1.0 AS idf
  FROM top_terms, (SELECT COUNT(*) AS n FROM doc_terms WHERE split = 'train') AS train_size),
token_pos AS (
  SELECT c.doc_id, u.t, u.pos
  FROM cleaned c, LATERAL (SELECT unnest(c.tokens) AS t, generate_subscripts(c.tokens, 1) AS pos) u)
"""


def _text(body: str) -> str:
    return with_standins(_text_ctes() + body)


_ZEROS = "[" + ", ".join(["0"] * 50) + "]"

TEXT_ORACLE = {
    "review_clean_text": "SELECT doc_id, label, array_to_string(tokens, ' ') AS clean_text FROM cleaned",
    "lemma_substitution": """,
all_tokens AS (SELECT DISTINCT t FROM token_pos),
lemmas AS (
  SELECT t AS token, substr(t, 1, length(t) - 1) AS lemma FROM all_tokens
  WHERE t LIKE '%s' AND length(t) > 2
    AND substr(t, 1, length(t) - 1) IN (SELECT t FROM all_tokens)),
rebuilt AS (
  SELECT p.doc_id, string_agg(coalesce(l.lemma, p.t), ' ' ORDER BY p.pos) AS txt
  FROM token_pos p LEFT JOIN lemmas l ON l.token = p.t GROUP BY p.doc_id)
SELECT c.doc_id, coalesce(r.txt, '') AS lemmatized_text
FROM cleaned c LEFT JOIN rebuilt r USING (doc_id)""",
    "split_train_test": "SELECT doc_id, split FROM split",
    "vocabulary_top_n": "SELECT term, term_index, total_count, doc_freq FROM vocab",
    "tfidf_fit": "SELECT term, term_index, doc_freq, round(idf, 6) AS idf FROM vocab",
    "tfidf_transform": """,
w AS (SELECT tf.doc_id, tf.term, v.term_index, tf.tf * v.idf AS w FROM tf JOIN vocab v USING (term))
SELECT doc_id, term, term_index, round(w / sqrt(SUM(w * w) OVER (PARTITION BY doc_id)), 6) AS weight FROM w""",
    "linear_scores": """,
w AS (SELECT tf.doc_id, tf.term, tf.tf * v.idf AS w FROM tf JOIN vocab v USING (term)),
unit AS (SELECT doc_id, term, w / sqrt(SUM(w * w) OVER (PARTITION BY doc_id)) AS weight FROM w),
z AS (
  SELECT doc_id, round(SUM(weight * ((CAST(('0x' || substr(md5(term), 1, 8)) AS BIGINT) % 2001 - 1000) / 1000.0)), 6) AS logit
  FROM unit GROUP BY doc_id)
SELECT c.doc_id, COALESCE(z.logit, CAST(0 AS DOUBLE)) AS logit,
       round(1 / (1 + exp(-COALESCE(z.logit, 0))), 6) AS probability_positive,
       CAST(COALESCE(z.logit, 0) > 0 AS INTEGER) AS predicted
FROM cleaned c LEFT JOIN z USING (doc_id)""",
    "class_weights": """
SELECT label, COUNT(*) AS n,
       CAST((SELECT COUNT(*) FROM doc_terms WHERE split = 'train') AS DOUBLE)
         / ((SELECT COUNT(DISTINCT label) FROM doc_terms WHERE split = 'train') * COUNT(*)) AS weight
FROM doc_terms WHERE split = 'train' GROUP BY label""",
    "encode_fixed_length": f""",
ids AS (
  SELECT p.doc_id, list(coalesce(v.term_index + 2, 1) ORDER BY p.pos) AS ids
  FROM token_pos p LEFT JOIN vocab v ON v.term = p.t GROUP BY p.doc_id)
SELECT c.doc_id, CAST(len(c.tokens) AS INTEGER) AS n_tokens,
       array_to_string(list_concat(coalesce(i.ids, []), {_ZEROS})[1:50], ',') AS input_ids
FROM cleaned c LEFT JOIN ids i USING (doc_id)""",
    "attention_mask": """
SELECT doc_id, array_to_string(list_transform(range(1, 51), lambda i: CASE WHEN i <= len(tokens) THEN 1 ELSE 0 END), ',') AS attention_mask
FROM cleaned""",
    "shuffle_batches": """
SELECT doc_id, row_number() OVER (ORDER BY h, doc_id) - 1 AS position,
       (row_number() OVER (ORDER BY h, doc_id) - 1) // 32 AS batch_id
FROM split WHERE split = 'train'""",
}

# Of the rules that fit a token's end, the longest whose result is a token as well.
def _rule_ctes() -> str:
    from marketlens.operators.lemmas import PORTUGUESE_RULES

    rules = ", ".join(f"('{a}', '{b}', {n})" for a, b, n in PORTUGUESE_RULES)
    return f""",
all_tokens AS MATERIALIZED (SELECT DISTINCT t FROM token_pos),
rules(suffix, replacement, least) AS (VALUES {rules}),
fits AS (
  SELECT a.t AS token, substr(a.t, 1, length(a.t) - length(suffix)) || replacement AS lemma, length(suffix) AS k
  FROM all_tokens a JOIN rules r ON suffix(a.t, r.suffix) AND length(a.t) - length(r.suffix) >= r.least),
forms AS (
  SELECT token, lemma FROM fits WHERE lemma <> token AND lemma IN (SELECT t FROM all_tokens)
  QUALIFY row_number() OVER (PARTITION BY token ORDER BY k DESC, lemma) = 1)"""


TEXT_ORACLE["rule_lemmas"] = _rule_ctes() + "\nSELECT token, lemma FROM forms"
TEXT_ORACLE["lemmas_by_rules"] = _rule_ctes() + """,
rebuilt AS (
  SELECT p.doc_id, string_agg(coalesce(f.lemma, p.t), ' ' ORDER BY p.pos) AS txt
  FROM token_pos p LEFT JOIN forms f ON f.token = p.t GROUP BY p.doc_id)
SELECT c.doc_id, coalesce(r.txt, '') AS lemmatized_text FROM cleaned c LEFT JOIN rebuilt r USING (doc_id)"""

TEXT_ORACLE["saved_model_scores"] = TEXT_ORACLE["linear_scores"]

# J5 with exact sizes: a fifth of all rows, rounded up, shared over the classes by largest
# remainders; in each class the rows of the smallest 60-bit digests.
TEXT_ORACLE["split_exact"] = """,
classes AS (
  SELECT label, COUNT(*) AS k, SUM(COUNT(*)) OVER () AS n, (SUM(COUNT(*)) OVER () * 20 + 99) // 100 AS total
  FROM corpus GROUP BY label),
shares AS (
  SELECT label, CAST(total * k // n AS BIGINT) AS whole, total,
         row_number() OVER (ORDER BY (total * k) % n DESC, label NULLS FIRST) AS turn FROM classes),
quotas AS (SELECT label, whole + CASE WHEN turn <= total - SUM(whole) OVER () THEN 1 ELSE 0 END AS quota FROM shares),
placed AS (
  SELECT doc_id, label, row_number() OVER (PARTITION BY label ORDER BY
         CAST(('0x' || substr(md5(CAST(doc_id AS VARCHAR) || ':42'), 1, 15)) AS BIGINT), doc_id) AS place FROM corpus)
SELECT p.doc_id, p.label, CASE WHEN p.place <= q.quota THEN 'test' ELSE 'train' END AS split
FROM placed p JOIN quotas q ON p.label IS NOT DISTINCT FROM q.label"""


def _exact_logit_ctes() -> str:
    """The steps of the exact logistic regression, one after the other.  Values are
    integers of 10^-8; the intercept is feature -1, with value one and without ridge."""
    from marketlens.operators.exact_logit import STEPS, momenta

    parts = [""",
w AS (SELECT tf.doc_id, tf.term, v.term_index, tf.tf * v.idf AS w FROM tf JOIN vocab v USING (term)),
unit AS (SELECT doc_id, term_index, w / sqrt(SUM(w * w) OVER (PARTITION BY doc_id)) AS weight FROM w),
x AS MATERIALIZED (
  SELECT doc_id, term_index AS i, CAST(floor(weight * 1e8 + 0.5) AS BIGINT) AS x FROM unit
  UNION ALL SELECT doc_id, -1, 100000000 FROM doc_terms),
rows AS MATERIALIZED (
  SELECT doc_id, split, label,
         CAST(SUM(CASE WHEN split = 'train' THEN 1 END) OVER () AS DOUBLE) AS n,
         CAST(SUM(CASE WHEN split = 'train' THEN 1 END) OVER () AS DOUBLE)
           / ((SELECT COUNT(DISTINCT label) FROM doc_terms WHERE split = 'train')
              * SUM(CASE WHEN split = 'train' THEN 1 END) OVER (PARTITION BY label)) AS balance
  FROM doc_terms),
tx AS MATERIALIZED (SELECT x.doc_id, x.i, x.x FROM x JOIN rows r ON r.doc_id = x.doc_id AND r.split = 'train'),
size AS (SELECT doc_id, SUM(x) AS s FROM tx GROUP BY doc_id),
bound AS (
  SELECT r.doc_id, CAST(floor(r.balance * CAST(s.s AS DOUBLE) / 1e4 + 0.5) AS BIGINT) AS q
  FROM rows r JOIN size s USING (doc_id)),
curve AS MATERIALIZED (
  SELECT tx.i, (SELECT MAX(n) FROM rows) AS n,
         0.25 * (CAST(CAST(SUM(tx.x * b.q) AS BIGINT) AS DOUBLE) / 1e8 / 1e4 / (SELECT MAX(n) FROM rows))
           + CASE WHEN tx.i < 0 THEN 0.0 ELSE 1.0 / (SELECT MAX(n) FROM rows) END AS scale
  FROM tx JOIN bound b USING (doc_id) GROUP BY tx.i),
b0 AS MATERIALIZED (SELECT i, CAST(0 AS BIGINT) AS now, CAST(0 AS BIGINT) AS ahead FROM curve)"""]
    for k, momentum in enumerate(momenta(STEPS)):
        parts.append(f""",
z{k} AS (SELECT tx.doc_id, CAST(CAST(SUM(tx.x * b.ahead) AS BIGINT) AS DOUBLE) / 1e8 / 1e8 AS z
  FROM tx JOIN b{k} b USING (i) GROUP BY tx.doc_id),
r{k} AS (SELECT z.doc_id, CAST(floor(r.balance * (1.0 / (1.0 + exp(-z.z)) - CAST(r.label AS DOUBLE)) * 1e8 + 0.5) AS BIGINT) AS r
  FROM z{k} z JOIN rows r USING (doc_id)),
g{k} AS (SELECT tx.i, CAST(CAST(SUM(tx.x * r.r) AS BIGINT) AS DOUBLE) AS g FROM tx JOIN r{k} r USING (doc_id) GROUP BY tx.i),
a{k} AS (
  SELECT b.i, b.now, CAST(floor((b.ahead / 1e8 - (g.g / 1e8 / 1e8 / c.n
           + CASE WHEN b.i < 0 THEN 0.0 ELSE 1.0 / c.n * (b.ahead / 1e8) END) / c.scale) * 1e8 + 0.5) AS BIGINT) AS after
  FROM b{k} b JOIN g{k} g USING (i) JOIN curve c USING (i)),
b{k + 1} AS MATERIALIZED (
  SELECT i, after AS now,
         after + CAST(floor(CAST({momentum!r} AS DOUBLE) * ((after - now) / 1e8) * 1e8 + 0.5) AS BIGINT) AS ahead
  FROM a{k})""")
    parts.append(f""",
model AS (SELECT i, now FROM b{STEPS}),
scored AS (
  SELECT r.doc_id, r.split, r.label, round(CAST(CAST(SUM(x.x * m.now) AS BIGINT) AS DOUBLE) / 1e8 / 1e8, 6) AS logit
  FROM x JOIN model m USING (i) JOIN rows r USING (doc_id) GROUP BY ALL)""")
    return "".join(parts)


def _exact_logit_oracle() -> dict[str, str]:
    steps = _exact_logit_ctes()
    return {
        "exact_logit_model": steps + """
SELECT COALESCE(v.term, '') AS term, floor((m.now + 50) / 100.0) / 1e6 AS coefficient
FROM model m LEFT JOIN vocab v ON v.term_index = m.i""",
        "exact_logit_scores": steps + """
SELECT doc_id, split, label, logit, round(1.0 / (1.0 + exp(-logit)), 6) AS probability_positive,
       CAST(logit > 0 AS INTEGER) AS predicted FROM scored""",
        "exact_logit_metrics": steps + """,
lines AS (
  SELECT s.split, s.doc_id, p.h, CASE WHEN (logit > 0) = (s.label = 1) THEN 1 ELSE 0 END AS hit,
         greatest(logit, 0.0) - logit * s.label + ln(1 + exp(-abs(logit))) AS loss
  FROM scored s JOIN split p USING (doc_id)),
batched AS (SELECT *, (row_number() OVER (PARTITION BY split ORDER BY h, doc_id) - 1) // 32 AS batch_id FROM lines),
per_batch AS (SELECT split, batch_id, AVG(loss) AS bl FROM batched GROUP BY split, batch_id)
SELECT r.split, r.n, r.accuracy, round(r.bce_loss, 6) AS bce_loss, round(b.mean, 6) AS bce_loss_batched
FROM (SELECT split, COUNT(*) AS n, AVG(hit) AS accuracy, AVG(loss) AS bce_loss FROM batched GROUP BY split) r
JOIN (SELECT split, AVG(bl) AS mean FROM per_batch GROUP BY split) b USING (split)"""}


# ---------------------------------------------------------------- runner
def _counts(status: str, extra: str) -> str:
    from marketlens.registry import RESULTS

    return "\nUNION ALL ".join(
        f"SELECT '{n}' AS name, '{status}' AS status, (SELECT COUNT(*) FROM ({ORACLE[n]})) AS rows{extra}"
        for n in RESULTS)


def _load_in_steps_sql() -> str:
    """Each table's own violations; keys that are there already; keys without a parent
    among what was loaded before.  All tables of the first step are loaded whole."""
    own = "(SELECT n FROM own WHERE table_name = '{}')"
    orphans = ("(SELECT COUNT(*) FROM {} WHERE {} IS NOT NULL AND {} NOT IN (SELECT {} FROM {} WHERE {} IS NOT NULL))")
    def lost(child, column, parent, key, where="true"):
        return orphans.format(f"(SELECT * FROM {STANDIN_TABLES[child]} WHERE {where})", column, column, key,
                              STANDIN_TABLES[parent], key)
    def count(table, where="true"):
        return f"(SELECT COUNT(*) FROM {STANDIN_TABLES[table]} WHERE {where})"
    steps = []
    for table in ("geolocation", "customers", "sellers", "prodcategory", "products"):
        terms = [own.format(table)] + [lost(*f) for f in FOREIGN_KEYS if f[0] == table]
        steps.append((1, table, " + ".join(terms)))
    for step, where in ((1, "order_id % 3 <> 0"), (2, "order_id % 3 = 0")):
        steps.append((step, "orders", " + ".join(lost(*f, where) for f in FOREIGN_KEYS if f[0] == "orders")))
    steps.append((2, "customers", own.format("customers") + " + " + count("customers") + " + "
                  + " + ".join(lost(*f) for f in FOREIGN_KEYS if f[0] == "customers")))
    steps.append((2, "order_items", " + ".join([own.format("order_items")]
                                               + [lost(*f) for f in FOREIGN_KEYS if f[0] == "order_items"])))
    steps.append((3, "orders", count("orders", "order_id % 5 = 0")))
    rows = "\nUNION ALL ".join(f"SELECT {k} AS step, '{t}' AS table_name, CAST({n} AS BIGINT) AS violations"
                               for k, t, n in steps)
    return with_standins(f""",
own AS (SELECT table_name, pk AS n FROM ({_load_report_body()})),
steps AS ({rows})
SELECT step, table_name, CASE WHEN violations > 0 THEN 'rejected' ELSE 'loaded' END AS status, violations FROM steps""")


def _load_gate_sql() -> str:
    """Own violations of each table, where keys without a parent are all of a child's
    keys if that parent was rejected; tables in the order of loading."""
    own = {}
    parts = [f"own AS (SELECT table_name, pk + len AS n FROM ({_load_report_body()}))"]
    for table in LOAD_ORDER:
        terms = [f"(SELECT n FROM own WHERE table_name = '{table}')"]
        for child, column, parent, parent_key in FOREIGN_KEYS:
            if child == table:
                terms.append(f"(SELECT COUNT(*) FROM {STANDIN_TABLES[child]} WHERE {column} IS NOT NULL AND "
                             f"((SELECT n FROM v_{parent}) > 0 OR {column} NOT IN (SELECT {parent_key} FROM "
                             f"{STANDIN_TABLES[parent]} WHERE {parent_key} IS NOT NULL)))")
        own[table] = f"v_{table} AS (SELECT {' + '.join(terms)} AS n)"
    body = "\nUNION ALL ".join(
        f"SELECT '{t}' AS table_name, CASE WHEN n > 0 THEN 'rejected' ELSE 'loaded' END AS status, "
        f"CAST(n AS BIGINT) AS violations FROM v_{t}" for t in LOAD_ORDER)
    return with_standins(",\n" + ",\n".join([*parts, *own.values()]) + "\n" + body)


def runner_oracle() -> dict[str, str]:
    return {"batch_report": _counts("ok", ", 'csv' AS format"), "publish_results": _counts("published", ""),
            "published_reviews": ORACLE["reviews"],
            "csv_scan": with_standins("SELECT review_id, order_id, review_score, review_comment_message, "
                                      "review_creation_date FROM st_order_reviews"),
            "load_gate": _load_gate_sql(), "load_in_steps": _load_in_steps_sql(), "sql_rmf": rmf_sql(), "sql_late_sellers": _late_sellers_sql(),
            "input_report": _input_report_sql()}


def _late_sellers_sql() -> str:
    return (f"SELECT s.seller_state, COUNT(*) AS n_sellers, COUNT(b.seller_id) AS n_late, "
            f"MAX(b.n_orders) AS most_rows FROM ({with_standins('SELECT * FROM st_sellers')}) s LEFT JOIN "
            f"(SELECT * FROM ({ORACLE['best_sellers']}) WHERE average_delay_days > 8) b USING (seller_id) GROUP BY 1")


def _input_report_sql() -> str:
    counts = "\nUNION ALL ".join(
        f"SELECT '{t}' AS table_name, 'found' AS status, (SELECT COUNT(*) FROM {STANDIN_TABLES[t]}) AS rows"
        for t in STANDIN_TABLES if t != "products")
    return with_standins(f"{counts}\nUNION ALL SELECT 'products', 'missing', NULL")


def text_oracle() -> dict[str, str]:
    """The text entries, built when asked for (they need the stop-word list)."""
    return {name: _text(body if body.startswith(",") else "\n" + body)
            for name, body in {**TEXT_ORACLE, **_exact_logit_oracle()}.items()}


BINARY_METRICS = with_standins(""",
scored AS (
  SELECT review_id AS doc_id, CAST(COALESCE(review_score, 0) AS DOUBLE) - 2.5 AS z,
         CASE WHEN review_score >= 3 THEN 1 ELSE 0 END AS y,
         CAST(('0x' || substr(md5(CAST(review_id AS VARCHAR) || ':42'), 1, 8)) AS BIGINT) AS h
  FROM st_order_reviews WHERE review_comment_message IS NOT NULL),
rows AS (
  SELECT CASE WHEN h % 100 < 20 THEN 'test' ELSE 'train' END AS split, doc_id, h,
         CASE WHEN (CASE WHEN 1 / (1 + exp(-z)) > 0.5 THEN 1.0 ELSE 0.0 END) = y THEN 1 ELSE 0 END AS hit,
         greatest(z, 0.0) - z * y + ln(1 + exp(-abs(z))) AS loss
  FROM scored),
batched AS (
  SELECT *, (row_number() OVER (PARTITION BY split ORDER BY h, doc_id) - 1) // 32 AS batch_id FROM rows),
per_batch AS (SELECT split, batch_id, AVG(loss) AS bl FROM batched GROUP BY split, batch_id)
SELECT r.split, r.n, r.accuracy, round(r.bce_loss, 9) AS bce_loss, round(b.bce_loss_batched, 9) AS bce_loss_batched
FROM (SELECT split, COUNT(*) AS n, AVG(hit) AS accuracy, AVG(loss) AS bce_loss FROM batched GROUP BY split) r
JOIN (SELECT split, AVG(bl) AS bce_loss_batched FROM per_batch GROUP BY split) b USING (split)
""")
ORACLE["binary_metrics"] = BINARY_METRICS
