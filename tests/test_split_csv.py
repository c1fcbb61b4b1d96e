"""Quoted CSV in splits against the multi-line reader, and SQL text with parameters."""

from __future__ import annotations

import os
import random
import tempfile

import pytest

from marketlens.sources.csv_files import (MissingInput, _reader, input_report, is_missing_path, read_csv_table)
from marketlens.sources.schemas import SCHEMAS
from tests.conftest import SMOKE_DIR, rows_of

HEAD = ("review_id,order_id,review_score,review_comment_title,review_comment_message,"
        "review_creation_date,review_answer_timestamp")


@pytest.fixture
def small_splits(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3000")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def write(folder, name, records, end="\n", last=True):
    with open(os.path.join(folder, name), "w", encoding="utf-8", newline="") as f:
        f.write(end.join([HEAD, *records]) + (end if last else ""))


def random_records(rng, n):
    pieces = ["a", "word ", ",", '""', "\n", "\n\n", "é", "中", "  ", "x" * 90, "\n,\n", '""\n""']
    out = []
    for i in range(n):
        if rng.random() < 0.7:
            text = '"' + "".join(rng.choice(pieces) for _ in range(rng.randint(0, 12))) + '"'
        else:
            text = rng.choice(["", "plain", "two words"])
        out.append(f"r{i},o{i},{rng.choice(['', 1, 5])},,{text},2018-01-02 00:00:00,")
    return out


def whole(spark, path):
    return rows_of(_reader(spark, "order_reviews").schema(SCHEMAS["order_reviews"]).csv(path))


@pytest.mark.parametrize("seed", range(3))
def test_equals_the_multi_line_reader(spark, small_splits, seed):
    rng, d = random.Random(seed), tempfile.mkdtemp(prefix="run-")
    for k in range(3):
        write(d, f"p{k}.csv", random_records(rng, rng.choice([0, 3, 120])), last=rng.random() < 0.5)
    write(d, "big.csv", random_records(rng, 150))
    assert spark.read.text(d).rdd.getNumPartitions() > 4
    assert rows_of(read_csv_table(spark, d, "order_reviews")) == whole(spark, d)


def test_a_record_over_many_splits(spark, small_splits):
    d = tempfile.mkdtemp(prefix="run-")
    text = "\n".join(f"line {k} " + "y" * 40 for k in range(200))
    write(d, "a.csv", [f'r1,o1,5,,"{text}",2018-01-02 00:00:00,', "r2,o2,1,,short,2018-01-02 00:00:00,"])
    got = {r["review_id"]: r["review_comment_message"] for r in read_csv_table(spark, d, "order_reviews").collect()}
    assert got == {"r1": text, "r2": "short"}


def test_carriage_returns_and_blank_lines(spark, small_splits):
    d = tempfile.mkdtemp(prefix="run-")
    write(d, "a.csv", ['r1,o1,5,,"two\r\nlines",2018-01-02 00:00:00,', "", "r2,o2,1,,x,2018-01-02 00:00:00,"], end="\r\n")
    got = {r["review_id"]: r["review_comment_message"] for r in read_csv_table(spark, d, "order_reviews").collect()}
    assert got == {"r1": "two\nlines", "r2": "x"}


def test_input_order_over_splits(spark, small_splits):
    d = tempfile.mkdtemp(prefix="run-")
    records = random_records(random.Random(7), 200)
    write(d, "a.csv", records)
    rows = read_csv_table(spark, d, "order_reviews", with_position=True).collect()
    assert [r["review_id"] for r in sorted(rows, key=lambda r: r["input_pos"])] == [f"r{i}" for i in range(200)]


def test_a_wrong_header_is_an_error(spark):
    d = tempfile.mkdtemp(prefix="run-")
    with open(os.path.join(d, "a.csv"), "w", encoding="utf-8") as f:
        f.write(HEAD.replace("review_score", "score") + "\nr1,o1,5,,x,2018-01-02 00:00:00,\n")
    with pytest.raises(Exception, match="(?i)header"):
        read_csv_table(spark, d, "order_reviews").collect()


def test_only_a_missing_path_is_a_missing_input(spark):
    from pyspark.errors import AnalysisException

    from marketlens.runner import read_loaded

    d = tempfile.mkdtemp(prefix="run-")
    write(d, "a.csv", ["r1,o1,5,,x,2018-01-02 00:00:00,"])
    report = input_report(spark, d, {"order_reviews": "a.csv", "orders": "gone.csv"}).collect()
    assert [(r["table_name"], r["status"], r["rows"]) for r in report] == [
        ("order_reviews", "found", 1), ("orders", "missing", None)]
    with pytest.raises(MissingInput):
        read_csv_table(spark, d + "/gone.csv", "order_reviews")
    os.makedirs(f"{d}/base/orders/load-1")  # there, but no table: no reason to skip the key checks
    with pytest.raises(AnalysisException) as caught:
        read_loaded(spark, f"{d}/base", "orders")
    assert not is_missing_path(caught.value)
    assert read_loaded(spark, f"{d}/base", "customers") is None


# ------------------------------------------------------------------------ SQL text
@pytest.fixture
def catalogue(spark):
    from marketlens.sources.sql_text import Catalogue
    from marketlens.sources.standins import load_standins

    c = Catalogue(spark, load_standins(spark, SMOKE_DIR), prefix="t_")
    yield c
    c.drop()


def test_k11_from_text(spark, catalogue):
    from marketlens import plans

    for dates in (("1998-01-01", "1999-07-01"), ("2000-01-01", "2000-07-01"), ("1900-01-01", "1900-02-01")):
        got = catalogue.query("SELECT * FROM t_rmf_per_client(CAST(:a AS TIMESTAMP_NTZ), CAST(:b AS TIMESTAMP_NTZ))",
                              dict(zip("ab", dates)))
        want = plans.rmf_per_client(catalogue.m, *dates)
        assert got.dtypes == want.dtypes and rows_of(got) == rows_of(want)


def test_every_result_is_a_function(catalogue):
    from marketlens.sources.sql_text import RESULTS

    for name, plan in RESULTS.items():
        if name != "network_delay":  # its rows are many
            assert rows_of(catalogue.query(f"SELECT * FROM t_{name}()")) == rows_of(plan(catalogue.m)), name


def test_values_are_parameters_not_text(catalogue):
    text = "SELECT COUNT(*) AS n FROM t_sellers WHERE seller_state = :state"
    assert catalogue.query(text, {"state": "x' OR '1' = '1"}).first()["n"] == 0
    assert catalogue.query(text.replace("=", "<>"), {"state": "x"}).first()["n"] > 0


def test_only_what_a_text_names_is_registered(spark, catalogue):
    catalogue.query("SELECT COUNT(*) FROM t_sellers")
    assert catalogue.views == {"t_sellers"} and not catalogue.functions
    catalogue.query("SELECT COUNT(*) FROM t_delays_by_state()")
    assert catalogue.functions == {"t_delays_by_state"}
    catalogue.drop()
    assert not spark.catalog.tableExists("t_sellers")


def test_a_filter_reaches_the_scan_through_a_function(catalogue):
    plan = catalogue.query("SELECT review_score FROM t_negative_reviews() WHERE review_score = 2")._jdf.queryExecution()
    assert "= 2" in plan.executedPlan().toString()


def test_lines_are_shuffled_once(spark, tmp_path):
    """By (file, split); records are put together there, only the rest of one that began in
    an earlier split moves."""
    from marketlens.sources.split_csv import records

    words = "one two three " * 10
    (tmp_path / "a.csv").write_text("a,b\n" + "".join(f'{k},"{words}\n{words}"\n' for k in range(200)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "5000")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        found = records(spark, str(tmp_path / "a.csv"))
        plan = found._jdf.queryExecution().executedPlan().toString()
        got = {r["record"] for r in found.collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert got == {"a,b", *(f'{k},"{words}\n{words}"' for k in range(200))}
    assert "begun" not in "".join(line for line in plan.splitlines() if "hashpartitioning" in line)
