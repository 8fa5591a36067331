"""Keep a target table in sync with export files landing in a folder.

The scheduled re-sync of exported tables, as a Structured Streaming query:
each micro-batch of newly landed CSV files goes through the sync plan
(missing tokens, row id, mapped types), is reduced to one row per id, and
rows whose id the target lacks are appended. The sink is idempotent, so a
micro-batch replayed after a failure adds nothing twice; progress is kept
in a checkpoint folder in the shared folder. With ``available_now`` the
query drains what has landed and stops (a batch-style run on a schedule);
without it, it keeps watching the folder.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql import types as T

from tablesmith.operators.rowid import ID
from tablesmith.plans.sync import SyncSpec, prepare
from tablesmith.session import work_path
from tablesmith.sources.files import csv_reader


def landing_sync(spark: SparkSession, landing_dir: str, columns: Sequence[str], spec: SyncSpec, store, *,
                 checkpoint: str | None = None, available_now: bool = True,
                 max_files_per_trigger: int | None = None, processing_time: str = "1 minute", multi_line: bool = True,
                 buckets: int | None = None, compact_parts: int = 64, keep_versions: int | None = None) -> StreamingQuery:
    """Start the landing-folder sync of ``spec.target_table``; returns the running query.

    Every file must have the header ``columns`` and whole records, or the query
    fails. A new target is bucketed by id when ``buckets`` is given, so that a
    micro-batch searches only the buckets it touches. When the target has more
    than ``compact_parts`` parts its small ones are brought together (large ones
    stay as they are); with ``keep_versions``, parts that only older versions use
    are then deleted, and the load history of those is packed into few files.
    """
    text_schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    # Files anywhere below the folder; folder names are never read as columns.
    reader = csv_reader(spark.readStream.schema(text_schema), multi_line=multi_line, recursive=True)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    rows = prepare(reader.csv(landing_dir), spec)
    if not store.exists(spec.target_table):
        out_schema = T.StructType([f for f in rows.schema.fields if f.name != spec.order_col])
        store.create_table(spec.target_table, out_schema, bucket_keys=[ID] if buckets else None, buckets=buckets)

    def load(batch: DataFrame, epoch_id: int) -> None:
        # One row per id (first in load order when an order column is given), absent ids only.
        own = store.with_session(batch.sparkSession)
        own.insert_ignore(spec.target_table, batch, [ID], order_by=spec.order_col)
        if own.n_parts(spec.target_table) > compact_parts:
            own.compact_small(spec.target_table)
            if keep_versions:
                own.pack_history(spec.target_table, keep_versions)

    w = (rows.writeStream.foreachBatch(load)
         .option("checkpointLocation", checkpoint or work_path(spark, "streams", spec.target_table)))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time)
    return w.start()
