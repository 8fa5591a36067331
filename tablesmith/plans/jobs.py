"""The sync job registry: pick due jobs, run each in isolation, write status back.

The registry holds one row per sync job (control metadata, one row per
table to keep in sync), so the driver reads the due rows and starts one
independent Spark sync per job; the data of each job never passes through
the driver. A failing job is retried a bounded number of times and then
marked FAILED without stopping the others.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from threading import Lock

from pyspark.errors import AnalysisException, IllegalArgumentException, ParseException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tablesmith.functions import expressions as fx
from tablesmith.functions.tokens import ALERT_ZONE, FAILED, PASS, PENDING
from tablesmith.operators.sizing import broadcast_if_small
from tablesmith.plans.sync import SyncSpec, mapping_from_rows, sync_table, text_export
from tablesmith.session import delete_path, work_path
from tablesmith.sinks.files import csv_export
from tablesmith.sources.files import csv_scan

JOB_DDL = ("job_id string, source_table string, source_sql string, target_table string, "
           "column_mapping array<struct<source_key:string,destination_key:string,data_type:string>>, "
           "status string, message string, updated_at bigint")
RESULT_DDL = "job_id string, status string, message string, updated_at bigint, rows_read bigint, rows_loaded bigint"

#: An optional registry column: a criteria that cuts a job's share out of its ``source_table``.
SOURCE_WHERE = "source_where"

#: The columns that a finished run sets.
STATE = ("status", "message", "updated_at")

# Registry rows a status write-back may broadcast: one per job.
MAX_JOBS_BROADCAST = 100_000


def due_jobs(jobs: DataFrame, pending: bool = False) -> DataFrame:
    """PENDING jobs when asked, else the PASS jobs (the regular re-sync); FAILED never."""
    return jobs.filter(F.col("status") == F.lit(PENDING if pending else PASS))


def apply_job_results(jobs: DataFrame, results: DataFrame, key: str = "job_id",
                      observation: Observation | None = None) -> DataFrame:
    """Keyed write-back of ``status``, ``message``, ``updated_at`` (other jobs unchanged).

    With ``observation``, ``matched`` reports how many registry rows were updated.
    """
    hit = fx.fresh("_hit", jobs.columns)
    new = {c: fx.fresh(f"_new_{c}", jobs.columns) for c in STATE}
    res = results.select(fx.col(key), *[F.col(c).alias(new[c]) for c in STATE], F.lit(True).alias(hit))
    joined = jobs.join(broadcast_if_small(res, MAX_JOBS_BROADCAST), on=key, how="left")
    if observation is not None:
        joined = joined.observe(observation, F.count_if(fx.col(hit).isNotNull()).alias("matched"))
    upd = {c: F.when(fx.col(hit), fx.col(new[c])).otherwise(fx.col(c)).cast(jobs.schema[c].dataType) for c in STATE}
    return joined.withColumns(upd).select(*[fx.col(c) for c in jobs.columns])


def update_job_state(jobs: DataFrame, job_id: str, status: str, message: str,
                     updated_at: int | Column | None = None, observation: Observation | None = None) -> DataFrame:
    """Set status, message and ``updated_at`` (epoch ms, default now) on one job row
    (``observation`` reports ``matched``: 1, or 0 when no job has that id)."""
    ts = updated_at if isinstance(updated_at, Column) else (
        fx.now_epoch_ms() if updated_at is None else F.lit(int(updated_at)))
    one = jobs.sparkSession.range(1).select(F.lit(str(job_id)).alias("job_id"), F.lit(status).alias("status"),
                                            F.lit(message).alias("message"), ts.cast("bigint").alias("updated_at"))
    return apply_job_results(jobs, one, observation=observation)


def failure_alerts(jobs: DataFrame, results: DataFrame, zone: str = ALERT_ZONE) -> DataFrame:
    """One alert row per job that this run's ``results`` report as FAILED: a subject stamped with the end of the run
    in ``zone`` and a description naming source, target and message."""
    failed = results.filter(F.col("status") == F.lit(FAILED)).select("job_id", "message", "updated_at")
    named = jobs.select("job_id", "source_table", "target_table")
    stamp = fx.zone_text(fx.utc_from_epoch_ms(F.col("updated_at")), zone)
    return named.join(broadcast_if_small(failed, MAX_JOBS_BROADCAST), "job_id").select(
        "job_id",
        F.concat(F.lit("Table sync failed "), stamp).alias("subject"),
        F.concat_ws("", F.lit("Sync of "), F.coalesce(F.col("source_table"), F.lit("?")), F.lit(" into "),
                    F.col("target_table"), F.lit(" ended FAILED: "),
                    F.coalesce(F.col("message"), F.lit("no message"))).alias("description"))


def _message(e: BaseException) -> str:
    return str(e) or type(e).__name__


#: Error conditions of Spark that the same data would meet again.
_DATA_ERRORS = ("CAST_INVALID_INPUT", "USER_RAISED_EXCEPTION", "MALFORMED", "CSV header does not conform", "DIVIDE_BY_ZERO",
                "ARITHMETIC_OVERFLOW", "not a number")


def is_transient(e: BaseException) -> bool:
    """Whether a run may succeed when it is tried again: not after errors of the mapping, the query or the data."""
    if isinstance(e, (AnalysisException, ParseException, IllegalArgumentException, ValueError, TypeError, KeyError)):
        return False
    return not any(x in str(e) for x in _DATA_ERRORS)


def _export(spark: SparkSession, job, source: Callable, hop: str | None) -> DataFrame:
    """The job's export as text: in-plan, or through CSV files in the shared folder (``hop="csv"``)."""
    src = source(spark, job)
    if hop is None:
        return text_export(src)
    if hop == "csv":
        path = csv_export(src, work_path(spark, "exports", job["target_table"]))
        return csv_scan(spark, path, na_tokens=None)
    raise ValueError(f"unknown export hop {hop!r}; use None or 'csv'")


def _run_one(spark: SparkSession, job, store, retries: int, source: Callable, hop: str | None = None,
             exported: DataFrame | None = None) -> tuple:
    last = None
    for _ in range(retries + 1):
        try:
            text = _export(spark, job, source, hop) if exported is None else exported
            spec = SyncSpec(mapping_from_rows(job["column_mapping"]), job["target_table"])
            res = sync_table(text, spec, store)
            return (job["job_id"], PASS, PASS, int(time.time()) * 1000, res.rows_read, res.rows_loaded)
        except Exception as e:  # one job's failure is recorded, never raised to the loop
            last = e
            if not is_transient(e):
                break
    return (job["job_id"], FAILED, _message(last), int(time.time()) * 1000, None, None)


def _criteria(job) -> str | None:
    return job[SOURCE_WHERE] if SOURCE_WHERE in job and job[SOURCE_WHERE] else None


def job_source(spark: SparkSession, job) -> DataFrame:
    """The export of a job: its SQL when given, else its source table (cut by ``source_where`` where the registry has that)."""
    if job["source_sql"]:
        return spark.sql(job["source_sql"])
    table, where = spark.table(job["source_table"]), _criteria(job)
    return table if where is None else table.filter(where)


def _routed(spark: SparkSession, source_table: str, jobs: list) -> tuple[DataFrame, list]:
    """One scan of a table for many jobs: its rows as exported text, once for each job (``_job``) whose criteria takes them;
    and the jobs. One whose criteria is no condition on that table is left out (it fails on its own)."""
    table, taken, own = spark.table(source_table), [], []
    for job in jobs:
        try:
            where = F.lit(True) if _criteria(job) is None else F.expr(_criteria(job))
            table.filter(where).schema      # analysed, not run
        except Exception:
            continue
        taken.append(F.when(where, F.lit(len(own))))
        own.append(job)
    name = fx.fresh("_job", table.columns)
    routes = F.array_compact(F.array(*taken)) if taken else F.array().cast("array<int>")
    routed = table.select(*[fx.col(c) for c in table.columns], routes.alias(name))
    return routed.select(*[fx.col(c).cast("string").alias(c) for c in table.columns], F.explode(fx.col(name)).alias(name)), own


def shared_exports(spark: SparkSession, jobs: list) -> tuple[dict[str, DataFrame], list[str]]:
    """Exports of jobs that name the same source table: each such table is scanned once and its rows are written to a folder
    per job in the shared folder. (job_id -> export as text, folders to delete at the end.)

    Rows of a job come together before they are written; a job with a large share
    is split over tasks. A table whose scan fails is left to its jobs one by one.
    """
    groups: dict[str, list] = {}
    for job in jobs:
        if not job["source_sql"] and job["source_table"]:
            groups.setdefault(job["source_table"], []).append(job)
    exports, folders = {}, []
    for source_table, own in groups.items():
        if len(own) < 2:
            continue
        path = work_path(spark, "exports", "shared")
        folders.append(path)
        try:
            rows, own = _routed(spark, source_table, own)
            name = rows.columns[-1]
            rows.hint("rebalance", fx.col(name)).write.partitionBy(name).parquet(path)
            text = rows.schema[:-1]
            fs = spark._jvm.org.apache.hadoop.fs.Path(path).getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
            for k, job in enumerate(own):
                folder = f"{path}/{name}={k}"
                there = fs.exists(spark._jvm.org.apache.hadoop.fs.Path(folder))
                exports[job["job_id"]] = spark.read.schema(text).parquet(folder) if there else spark.createDataFrame([], text)
        except Exception:
            continue
    return exports, folders


def run_jobs(spark: SparkSession, jobs: DataFrame, store, *, pending: bool = False, where: str | None = None,
             max_workers: int = 4, retries: int = 2, source: Callable = job_source,
             hop: str | None = None, on_result: Callable | None = None, share: bool = True) -> tuple[DataFrame, DataFrame]:
    """Run due jobs (or those matching ``where``); returns ``(results, updated registry)``.

    Transient failures are tried again ``retries`` times. ``on_result`` is
    called with each job's result row (RESULT_DDL) as the job ends.

    ``hop="csv"`` exports each source to CSV files in the shared folder and
    imports those (the file-based path); by default the export stays in-plan.
    Jobs that name one source table (no SQL of their own) ``share`` a scan of it;
    each then loads on its own, so one that fails stops none of the others.
    """
    chosen = jobs.filter(F.expr(where)) if where else due_jobs(jobs, pending)
    todo = chosen.collect()  # registry rows: one per job
    exports, folders = shared_exports(spark, todo) if share and hop is None and source is job_source else ({}, [])

    def one(job) -> tuple:
        row = _run_one(spark, job, store, retries, source, hop, exports.get(job["job_id"]))
        if on_result is not None:
            on_result(row)
        return row

    try:
        with ThreadPoolExecutor(max_workers=max(1, max_workers)) as pool:
            rows = list(pool.map(one, todo))
    finally:
        for path in folders:
            delete_path(spark, path)
    results = spark.createDataFrame(rows, RESULT_DDL)
    return results, apply_job_results(jobs, results)


def refetch(spark: SparkSession, jobs: DataFrame, store, where: str, **kw) -> tuple[DataFrame, DataFrame]:
    """Re-run the sync for the jobs matching ``where``, whatever their status."""
    return run_jobs(spark, jobs, store, where=where, **kw)


def run_registry(spark: SparkSession, store, registry_table: str, *, pending: bool = False,
                 where: str | None = None, **kw) -> DataFrame:
    """Run the due jobs of a registry table in ``store`` and write their status back.

    Each job's status is written by key as the job ends, against the registry
    as it then is: rows that others add or change meanwhile stay, and a crash
    loses the status of running jobs only. Returns the per-job results.
    """
    jobs, writing = store.read(registry_table), Lock()

    def write_back(row: tuple) -> None:
        job_id, status, message, updated_at = row[:4]
        with writing:  # one writer at a time in this process; the store's version check guards against others
            state = spark.createDataFrame([(job_id, status, message, updated_at)],
                                          "job_id string, status string, message string, updated_at bigint")
            store.update_matching(registry_table, state, ["job_id"])

    results, _ = run_jobs(spark, jobs, store, pending=pending, where=where, on_result=write_back, **kw)
    return results
