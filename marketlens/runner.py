"""Batch runs (B1-B5, B7): named queries with per-query fault isolation, gated table
loads, and publishing results to a serving location.

Every query runs exactly once; its rows are counted by the job that writes them.
Nothing is collected to the driver but the one-row report entries.

usage: python -m marketlens.runner --sf-dir DIR --out DIR [--format csv] [name ...]
"""

from __future__ import annotations

import argparse
import hashlib
import json
import threading
import time
import traceback
import uuid
from collections.abc import Callable, Iterable, Mapping, Sequence
from concurrent.futures import Future, ThreadPoolExecutor
from weakref import WeakKeyDictionary

from pyspark import inheritable_thread_target
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketlens.operators.quality import load_violations
from marketlens.session import remove_scratch, scratch_folder
from marketlens.sources.csv_files import CSV_READ, CSV_WRITE, is_missing_path
from marketlens.sources.schemas import FOREIGN_KEYS, LOAD_ORDER, PRIMARY_KEYS

REPORT_SCHEMA = T.StructType([
    T.StructField("name", T.StringType()), T.StructField("status", T.StringType()),
    T.StructField("rows", T.LongType()), T.StructField("seconds", T.DoubleType()),
    T.StructField("path", T.StringType()), T.StructField("format", T.StringType()),
    T.StructField("schema", T.StringType()), T.StructField("error", T.StringType())])


def _to(df: DataFrame, path: str, fmt: str, compression: str | None) -> None:
    writer = df.write.mode("overwrite").format(fmt)
    if compression:
        writer = writer.option("compression", compression)
    (writer.options(**CSV_WRITE) if fmt == "csv" else writer).save(path)


def read_result(spark: SparkSession, path: str, fmt: str, schema: T.StructType | None = None) -> DataFrame:
    """A2: a written result, with the options it was written with and its own types."""
    reader = spark.read.format(fmt)
    if fmt == "csv":
        reader = reader.options(**CSV_READ)
    return (reader.schema(schema) if schema is not None else reader).load(path)


_COUNTING: WeakKeyDictionary = WeakKeyDictionary()  # session -> its session for counted writes
_COUNTING_LOCK = threading.Lock()


def _counting_session(spark: SparkSession) -> SparkSession:
    """A session beside ``spark`` with its settings.  Observed metrics are kept out of the
    caller's session: one that has used them can't serialise Spark ML's training closures."""
    with _COUNTING_LOCK:
        beside = _COUNTING.get(spark)
        if beside is None:
            beside = _COUNTING[spark] = spark.newSession()
        for key, value in spark.conf.getAll.items():
            if beside.conf.get(key, None) != value and beside.conf.isModifiable(key):
                beside.conf.set(key, value)
        return beside


def write_result(df: DataFrame, path: str, fmt: str = "parquet", compression: str | None = None) -> int:
    """B2: replace the result at ``path``; returns its row count.  CSV results get a
    header.  Files are written in parallel, one per task: a sorted result stays sorted
    across the part files in name order.  Rows are counted by the job that writes them.
    ``compression`` names a codec of the format, for example gzip for CSV; ``read_result``
    knows it by the files' names."""
    view, rows = f"counted_{uuid.uuid4().hex}", Observation()
    df.createGlobalTempView(view)
    try:
        beside = _counting_session(df.sparkSession)
        counted = beside.table(f"global_temp.{view}").observe(rows, F.count(F.lit(1)).alias("rows"))
        _to(counted, path, fmt, compression)
        return rows.get["rows"]
    finally:
        df.sparkSession.catalog.dropGlobalTempView(view)


class BatchControl:
    """Stops single queries of a running batch, from another thread."""

    def __init__(self):
        self._stopped: set[str] = set()

    def cancel(self, name: str) -> None:
        self._stopped.add(name)

    def is_cancelled(self, name: str) -> bool:
        return name in self._stopped


class _Running:
    """What a batch's watch needs to know of a query: its tag and since when it runs."""

    def __init__(self, name: str):
        self.name, self.tag, self.since, self.verdict = name, f"marketlens-{uuid.uuid4().hex}", time.time(), None


def _watch(spark: SparkSession, running: dict[str, _Running], limit: float | None, control: BatchControl,
           over: threading.Event) -> None:
    """Cancels the jobs of queries that are over their time or stopped by ``control``,
    again and again, as a query may start another job before it fails."""
    while not over.wait(0.2):
        for query in list(running.values()):
            if control.is_cancelled(query.name):
                query.verdict = "cancelled"
            elif limit is not None and time.time() - query.since > limit:
                query.verdict = "timed out"
            if query.verdict:
                spark.sparkContext.cancelJobsWithTag(query.tag)


def run_batch(spark: SparkSession, queries: Mapping[str, Callable[[], DataFrame]], out_dir: str,
              fmt: str = "parquet", workers: int = 4, time_limit: float | None = None,
              control: BatchControl | None = None, compression: str | None = None) -> DataFrame:
    """Run every named query, write it under ``out_dir/name``; a failing query is
    recorded with its whole error and the batch goes on.  Returns the report, in the
    order of ``queries``.

    Up to ``workers`` queries run at a time, each in a thread, a scheduler pool and under a
    job tag of its own, so a long one doesn't hold up the others (with
    ``spark.scheduler.mode=FAIR`` pools also share the executors evenly), and one that
    passes ``time_limit`` seconds or is cancelled through ``control`` is stopped alone.
    """
    control, running, over = control or BatchControl(), {}, threading.Event()
    sc = spark.sparkContext

    def run(name: str, build: Callable[[], DataFrame]) -> tuple:
        path = f"{out_dir.rstrip('/')}/{name}"
        query = running[name] = _Running(name)
        sc.addJobTag(query.tag)
        sc.setLocalProperty("spark.scheduler.pool", name)
        try:
            if control.is_cancelled(name):
                query.verdict = "cancelled"
                raise RuntimeError("cancelled before it began")
            df = build()
            n = write_result(df, path, fmt, compression)
            return name, "ok", n, time.time() - query.since, path, fmt, df.schema.json(), None
        except Exception as exc:  # noqa: BLE001 - isolation is the point
            return (name, query.verdict or "error", None, time.time() - query.since, path, fmt, None,
                    f"{type(exc).__name__}: {exc}")
        finally:
            running.pop(name, None)
            sc.removeJobTag(query.tag)
            sc.setLocalProperty("spark.scheduler.pool", None)

    watch = threading.Thread(target=_watch, args=(spark, running, time_limit, control, over), daemon=True)
    watch.start()
    try:
        with ThreadPoolExecutor(max_workers=max(1, workers)) as pool:
            started = [pool.submit(inheritable_thread_target(spark)(run), name, build)
                       for name, build in queries.items()]
            rows = [s.result() for s in started]
    finally:
        over.set()
        watch.join()
    return spark.createDataFrame(rows, REPORT_SCHEMA)


# ------------------------------------------------------------------ loads into targets
BUCKETING = "schema string, buckets int, keys string"


def _bucketing(spark: SparkSession, folder: str) -> tuple | None:
    """(schema, buckets, keys) of a bucketed target; None where there is none."""
    try:
        spec = spark.read.schema(BUCKETING).parquet(f"{folder}/_bucketing").first()
    except AnalysisException as exc:
        if not is_missing_path(exc):
            raise
        return None
    return T.StructType.fromJson(json.loads(spec["schema"])), spec["buckets"], spec["keys"].split(",")


def _write_bucketed(spark: SparkSession, df: DataFrame, keys: Sequence[str], buckets: int, path: str) -> None:
    """Files of one bucket each, written by every task from what it holds: the rows are not
    dealt out into ``buckets`` tasks first, nor sorted inside a bucket, as no reader counts on
    that.  The table's name is needed for the writing only."""
    name = f"marketlens_write_{uuid.uuid4().hex}"
    df.write.format("parquet").bucketBy(buckets, *keys).option("path", path).saveAsTable(name)
    spark.sql(f"DROP TABLE {name}")  # an external table's files stay


def _read_bucketed(spark: SparkSession, folder: str, spec: tuple) -> DataFrame:
    """All loads as one bucketed table: a load is a partition, so a bucket's files of all
    loads are read by one task and joins by key need no exchange of this side."""
    schema, buckets, keys = spec
    name = f"marketlens_target_{hashlib.md5(folder.encode()).hexdigest()}"
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    key_list = ", ".join(f"`{k}`" for k in keys)
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(f"CREATE TABLE {name} ({columns}, `load` string) USING parquet PARTITIONED BY (`load`) "
              f"CLUSTERED BY ({key_list}) INTO {buckets} BUCKETS LOCATION '{folder}'")
    spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")
    return spark.table(name).drop("load")


def read_loaded(spark: SparkSession, out_dir: str, table: str) -> DataFrame | None:
    """The rows of every load of a table so far; None before the first."""
    spec = _bucketing(spark, f"{out_dir.rstrip('/')}/{table}")
    if spec is not None:
        return _read_bucketed(spark, f"{out_dir.rstrip('/')}/{table}", spec)
    try:
        return spark.read.parquet(f"{out_dir.rstrip('/')}/{table}/load-*")
    except AnalysisException as exc:  # nothing loaded yet; any other error would switch checks off
        if not is_missing_path(exc):
            raise
        return None


def _commit(spark: SparkSession, staged: str, final: str) -> None:
    """Move a fully written folder to its place: one rename, so a load that failed
    before leaves nothing behind."""
    sc = spark.sparkContext
    new_path = sc._jvm.org.apache.hadoop.fs.Path
    store = new_path(final).getFileSystem(sc._jsc.hadoopConfiguration())
    store.mkdirs(new_path(final).getParent())
    if not store.rename(new_path(staged), new_path(final)):
        raise OSError(f"could not move {staged} to {final}")


def _remove(spark: SparkSession, folder: str) -> None:
    sc = spark.sparkContext
    path = sc._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)


def load_tables(spark: SparkSession, tables: Mapping[str, DataFrame], out_dir: str,
                partition_by: Mapping[str, Mapping] | None = None, buckets: int | None = None,
                workers: int = 4) -> DataFrame:
    """B1 + B4 + C11: append each table, parents first, only if its rules report nothing.

    Rules look at what the table is loaded into: keys that an earlier load brought count
    as taken, and a parent is what this run has loaded or an earlier one had; so when
    a parent is rejected, its children are as well.  A table is written beside its
    target and moved there whole.  Each table is isolated from the others' failures.
    ``partition_by`` maps new columns to expressions written as directory partitions (for
    example ``{"orders": {"purchase_month": month_floor(F.col("order_purchase_timestamp"))}}``),
    so later date-bounded scans read only the matching folders.

    With ``buckets`` every target is kept bucketed by its primary key.  The key and parent
    checks of later loads then shuffle the new rows only, never what is already loaded.
    The new rows are made once, beside the target; the rules read them there, and what is
    rejected is removed.  Up to ``workers`` tables are worked on at a time; the rules of one
    wait until its parents are loaded or not.
    A target keeps the number of buckets it began with.
    """
    if buckets and partition_by:
        raise ValueError("a target is either bucketed or partitioned by columns")
    base = out_dir.rstrip("/")
    done: dict[str, Future] = {}
    known: dict[str, DataFrame | None] = {}
    reading = threading.Lock()

    def loaded(parent: str) -> DataFrame | None:
        with reading:  # once a run, and not before the parent's own load is over
            if parent not in known:
                known[parent] = read_loaded(spark, base, parent)
            return known[parent]

    def load_one(name: str) -> tuple:
        try:
            spec, rows = _bucketing(spark, f"{base}/{name}"), tables[name]
            if spec is not None and spec[1] != buckets:
                raise ValueError(f"{name} is kept in {spec[1]} buckets, not {buckets}")
            if buckets:
                keys, load = list(PRIMARY_KEYS[name]), f"load={uuid.uuid4().hex[:12]}"
                staged = f"{base}/_staging/{name}-{load}"
                _write_bucketed(spark, rows, keys, buckets, staged)
                rows = spark.read.schema(rows.schema).parquet(staged)
            # parents not given are outside this load and not checked, unless loaded before
            parents = {}
            for _, _, parent, _ in [f for f in FOREIGN_KEYS if f[0] == name]:
                if parent in done:
                    done[parent].result()
                if parent in tables or loaded(parent) is not None:
                    parents[parent] = loaded(parent)
            bad = load_violations(name, rows, parents, read_loaded(spark, base, name), buckets)
            if bad:
                if buckets:
                    _remove(spark, staged)
                return name, "rejected", bad, base
            if buckets:
                _commit(spark, staged, f"{base}/{name}/{load}")
                if spec is None:  # from now on the target is there
                    about = [(tables[name].schema.json(), buckets, ",".join(keys))]
                    spark.createDataFrame(about, BUCKETING).coalesce(1).write.parquet(f"{base}/{name}/_bucketing")
                return name, "loaded", 0, base
            load = f"load-{uuid.uuid4().hex[:12]}"
            df, extra = tables[name], (partition_by or {}).get(name) or {}
            writer = df.withColumns(dict(extra)).write if extra else df.write
            staged = f"{base}/_staging/{name}-{load}"
            (writer.partitionBy(*extra) if extra else writer).parquet(staged)
            _commit(spark, staged, f"{base}/{name}/{load}")
            return name, "loaded", 0, base
        except Exception as exc:  # noqa: BLE001
            return name, f"error: {type(exc).__name__}: {exc}", None, base

    with ThreadPoolExecutor(max_workers=workers) as pool:  # in load order, so none waits for one that can't begin
        for name in [t for t in LOAD_ORDER if t in tables]:
            done[name] = pool.submit(inheritable_thread_target(spark)(load_one), name)
        results = [f.result() for f in done.values()]
    return spark.createDataFrame(results, "table_name string, status string, violations long, path string")


def publish_results(spark: SparkSession, report: DataFrame, target_dir: str,
                    exclude: Iterable[str] = (), compression: str | None = None) -> DataFrame:
    """Re-write every successful result of a batch report to ``target_dir``, except
    deny-listed names, by reading and writing the dataset (never a file copy), with the
    result's own schema.  Returns what was published, with its row count."""
    excluded = set(exclude)
    done = []
    for r in report.filter(F.col("status") == "ok").collect():  # one row per query
        if r["name"] in excluded:
            done.append((r["name"], "skipped", None, None))
            continue
        dest = f"{target_dir.rstrip('/')}/{r['name']}"
        schema = T.StructType.fromJson(json.loads(r["schema"]))
        n = write_result(read_result(spark, r["path"], r["format"], schema), dest, r["format"], compression)
        done.append((r["name"], "published", n, dest))
    return spark.createDataFrame(done, "name string, status string, rows long, path string")


def publish_models(models: Mapping[str, str], target_dir: str,
                   exclude: Iterable[str] = ("bert",)) -> list[tuple[str, str]]:
    """B7 for fitted pipelines: load each saved model and save it under
    ``target_dir/name`` unless its name is deny-listed."""
    from pyspark.ml import PipelineModel

    out = []
    for name, path in models.items():
        if name in set(exclude):
            out.append((name, "skipped"))
            continue
        PipelineModel.load(path).write().overwrite().save(f"{target_dir.rstrip('/')}/{name}")
        out.append((name, "published"))
    return out


def run_folder(spark: SparkSession, label: str) -> str:
    """A fresh folder for a run's outputs inside the shared checkpoint folder."""
    return scratch_folder(spark, label)


def main(argv=None) -> None:
    from marketlens import registry
    from marketlens.session import local_session

    ap = argparse.ArgumentParser(description=__doc__)
    ap.add_argument("--sf-dir", default="/root/testdata/sf0.01")
    ap.add_argument("--out", required=True)
    ap.add_argument("--format", default="parquet", choices=["parquet", "csv"])
    ap.add_argument("--publish-to")
    ap.add_argument("names", nargs="*")
    args = ap.parse_args(argv)
    spark = SparkSession.getActiveSession() or local_session()
    qs = registry.queries()
    names = args.names or list(qs)
    report = run_batch(spark, {n: (lambda n=n: qs[n](spark, args.sf_dir)) for n in names},
                       args.out, args.format)
    report.show(len(names), truncate=80)
    if args.publish_to:
        publish_results(spark, report, args.publish_to).show(len(names), truncate=80)
    remove_scratch(spark)


if __name__ == "__main__":
    try:
        main()
    except Exception:  # pragma: no cover
        traceback.print_exc()
        raise
