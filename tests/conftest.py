from __future__ import annotations

import datetime as dt
import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SMOKE_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from marketlens.session import local_session

    s = local_session(cpus=4, shuffle_partitions=4, app_name="marketlens-tests")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def duck():
    import duckdb

    from marketlens.sources.standins import DRIVER_TABLES

    con = duckdb.connect()
    for t in DRIVER_TABLES:
        p = f"{SMOKE_DIR}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


# Schemas of the stand-in tables (integer ids), for hand-made frames.
TABLE_DDL = {
    "geolocation": "geolocation_zip_code_prefix string, geolocation_lat double, geolocation_lng double, "
                   "geolocation_city string, geolocation_state string",
    "customers": "customer_id long, customer_unique_id long, customer_zip_code_prefix string, "
                 "customer_city string, customer_state string",
    "orders": "order_id long, customer_id long, order_status string, order_purchase_timestamp timestamp_ntz, "
              "order_approved_at timestamp_ntz, order_delivered_carrier_date timestamp_ntz, "
              "order_delivered_customer_date timestamp_ntz, order_estimated_delivery_date timestamp_ntz",
    "sellers": "seller_id long, seller_zip_code_prefix string, seller_city string, seller_state string",
    "prodcategory": "product_category_name string, product_category_name_english string",
    "products": "product_id long, product_category_name string",
    "order_items": "order_id long, order_item_id int, product_id long, seller_id long, "
                   "shipping_limit_date timestamp_ntz, price double, freight_value double",
    "order_payments": "order_id long, payment_sequential int, payment_type string, "
                      "payment_installments int, payment_value double",
    "order_reviews": "review_id long, order_id long, review_score int, review_comment_message string, "
                     "review_creation_date timestamp_ntz",
}


def ts(s: str) -> dt.datetime:
    return dt.datetime.fromisoformat(s)


@pytest.fixture
def make_market(spark):
    from marketlens.sources.marketplace import Marketplace

    def build(**rows):
        frames = {name: spark.createDataFrame(rows.get(name, []), ddl)
                  for name, ddl in TABLE_DDL.items()}
        return Marketplace(**frames)

    return build


def rows_of(df, order_by=None):
    out = [tuple(r) for r in df.collect()]
    return sorted(out, key=repr) if order_by is None else out


# Pieces of review text and what survives cleaning (lower case, no tags, ASCII letters
# and digits only), known in advance.
_LETTERS = [("a", "a"), ("B", "b"), ("z", "z"), ("Q", "q"), ("7", "7"), ("0", "0"), ("\u212a", "k"), ("\u0130", "i"),
            ("ã", ""), ("É", ""), ("ß", ""), ("ﬁ", ""), ("中", ""), ("\U0001F600", ""), ("!", ""), ("-", ""),
            ("'", ""), (">", ""), ("\x00", ""), ("<b>", ""), ("</p>", ""), ("<a href='x y'>", ""), ("<>", "")]
_BLANKS = [" ", "  ", "\n", "\t", "\r\n", "\x0b", "\x0c", "\x1c", "\x1f", "\x85", "\xa0", "\u2003", "\u2028", "\u3000"]


def assembled_text(rng) -> tuple[str, list[str]]:
    """A random text and the tokens that cleaning must leave of it."""
    text, tokens = rng.choice(["", *_BLANKS]), []
    for _ in range(rng.randint(0, 12)):
        pieces = [rng.choice(_LETTERS) for _ in range(rng.randint(1, 6))]
        if rng.random() < 0.1:  # a tag doesn't span lines: its words stay
            pieces = [("<x\ny>", "x y")]
        text += "".join(raw for raw, _ in pieces) + rng.choice(_BLANKS)
        tokens += "".join(left for _, left in pieces).split()
    return text, tokens
