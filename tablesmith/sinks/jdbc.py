"""JDBC loads (e.g. a PostgreSQL target). Executors insert their partitions in
batches in parallel, instead of one round trip per row.

Not exercised by the tests: it needs a database server, which the test
environment does not run.
"""

from __future__ import annotations

from pyspark.sql import DataFrame


def jdbc_load(df: DataFrame, url: str, table: str, *, mode: str = "overwrite", properties: dict | None = None,
              batch_size: int = 10_000, num_partitions: int | None = None, column_types: str | None = None) -> None:
    """Write ``df`` to ``table``. ``mode="overwrite"`` drops and re-creates it (full refresh)."""
    w = df.write.mode(mode).option("batchsize", str(batch_size))
    if num_partitions:
        w = w.option("numPartitions", str(num_partitions))
    if column_types:
        w = w.option("createTableColumnTypes", column_types)
    w.jdbc(url, table, properties=properties or {})
