from __future__ import annotations

from marketlens.operators.quality import (
    duplicate_keys, fk_violations, length_violations, pk_violations, table_report,
)
from tests.conftest import rows_of


def _tables(spark):
    sellers = spark.createDataFrame(
        [("s1", "z1", "city", "SP"), ("s1", "z1", "city", "SP"), (None, "z2", "c", "RJ"),
         ("s2", "zz", "x" * 51, "SP")],
        "seller_id string, seller_zip_code_prefix string, seller_city string, seller_state string")
    geo = spark.createDataFrame([("z1", 0.0, 0.0, "c", "SP"), ("z2", 0.0, 0.0, "c", "SP")],
                                "geolocation_zip_code_prefix string, geolocation_lat double, "
                                "geolocation_lng double, geolocation_city string, geolocation_state string")
    return {"sellers": sellers, "geolocation": geo}


def test_pk_counts_duplicates_and_null_keys(spark):
    out = {r["table_name"]: r for r in pk_violations(_tables(spark)).collect()}
    assert (out["sellers"]["n_duplicate_keys"], out["sellers"]["n_duplicate_rows"],
            out["sellers"]["n_null_key_rows"]) == (1, 2, 1)
    assert (out["geolocation"]["n_duplicate_rows"], out["geolocation"]["n_null_key_rows"]) == (0, 0)
    assert rows_of(duplicate_keys(_tables(spark)["sellers"], ["seller_id"])) == [("s1", 2)]


def test_fk_counts_orphans_but_not_nulls(spark):
    out = {(r["child_table"], r["child_column"]): r for r in fk_violations(_tables(spark)).collect()}
    r = out[("sellers", "seller_zip_code_prefix")]
    assert (r["n_orphan_rows"], r["n_orphan_keys"]) == (1, 1)


def test_length_rule_and_load_verdict(spark):
    out = {(r["table_name"], r["column_name"]): r for r in length_violations(_tables(spark)).collect()}
    assert out[("sellers", "seller_city")]["n_violations"] == 1
    assert out[("sellers", "seller_city")]["longest"] == 51
    assert out[("sellers", "seller_id")]["n_violations"] == 0
    verdict = {r["table_name"]: r["loadable"] for r in table_report(_tables(spark)).collect()}
    assert verdict == {"sellers": False, "geolocation": True}
