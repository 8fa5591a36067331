"""A bounded sample of labelled rows to fit a classifier on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablesmith.functions.expressions import col

#: Bounds of a training sample: rows, and bytes of text.
MAX_ROWS, MAX_BYTES = 6000, 8 << 20


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, *, where: Column | None = None,
                    max_rows: int = MAX_ROWS, max_bytes: int = MAX_BYTES, also: str | None = None) -> list[tuple]:
    """(text, label) of at most ``max_rows`` labelled documents and ``max_bytes`` of text; (text, label, ``also``) with
    another column of ``docs``, as a long.

    The order of a hash of the id decides, so the sample does not depend on
    partitions. Rows with a null id or label are left out; an id labelled more
    than once counts with its largest label, and of different documents under one
    id the first by text; a text that alone exceeds what is left of the bytes is
    passed over. ``where`` is a condition on ``doc_id``.
    """
    own = labels.select(col("doc_id").cast("long").alias("doc_id"), col(label).cast("int").alias("label")).na.drop()
    own = (own if where is None else own.filter(where)).groupBy("doc_id").agg(F.max("label").alias("label"))
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    chosen = F.broadcast(own.orderBy(*order).limit(max_rows))      # at most max_rows rows
    more = F.lit(None).cast("long") if also is None else col(also).cast("long")
    rows = docs.select(col("doc_id").cast("long").alias("doc_id"), col("text").cast("string").alias("text"), more.alias("also")) \
        .join(chosen, "doc_id")
    sizes = rows.select("doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).alias("n"), F.xxhash64("doc_id").alias("h")) \
        .groupBy("doc_id", "h").agg(F.max("n").alias("n")).collect()
    left, taken = max_bytes, []
    for r in sorted(sizes, key=lambda r: (r["h"], r["doc_id"])):
        if r["n"] <= left:
            left -= r["n"]
            taken.append((r["doc_id"],))
    if not taken:
        return []
    ids = F.broadcast(docs.sparkSession.createDataFrame(taken, "doc_id long"))
    first = F.min(F.struct(F.coalesce("text", F.lit("")).alias("text"), "also", "label")).alias("r")
    found = rows.join(ids, "doc_id").groupBy("doc_id").agg(first).select("doc_id", "r.*").collect()
    return [(r["text"].encode(), int(r["label"]), *([] if also is None else [r["also"]])) for r in sorted(found, key=lambda r: r["doc_id"])]
