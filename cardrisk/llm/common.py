"""Shared plumbing of the operators: sessions, written tables, Arrow text columns.

Documents are identified inside an operator by ``(doc_id, text hash)``, so a
null or repeated ``doc_id`` never mixes two different texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cardrisk.session import ensure_conf, scratch_path, ship_package, table_path

# Rows in one Arrow batch handed to Python: some MB of ordinary documents.
ARROW_ROWS = 1000
# Text bytes that one numpy step works on (a longer document is one step).
SLICE_BYTES = 1 << 20


def prepare(spark: SparkSession, python: bool = True) -> SparkSession:
    """Session settings the operators rely on; ships the package to Python workers."""
    ensure_conf(spark)
    if python:
        ship_package(spark)
        if spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch", "10000") == "10000":
            spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    return spark


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def written(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage: write under the shared checkpoint folder and read back.

    The files outlive lost executors, and a later retry reads the same rows.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_hash(text: str = "text") -> Column:
    return F.xxhash64(F.coalesce(F.col(text), F.lit("")))


def keyed(docs: DataFrame) -> DataFrame:
    """``doc_id, text_key, text``: the columns that the operators work on (null text: empty)."""
    return docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        text_hash().alias("text_key"),
        F.coalesce(F.col("text"), F.lit("")).alias("text"),
    )


def join_docs(a: DataFrame, b: DataFrame, how: str = "inner") -> DataFrame:
    """Join two tables by document; ``a``'s keys stay."""
    b = b.withColumnsRenamed({"doc_id": "_other_id", "text_key": "_other_key"})
    same = F.col("doc_id").eqNullSafe(F.col("_other_id")) & (F.col("text_key") == F.col("_other_key"))
    return a.join(b, same, how).drop("_other_id", "_other_key")


def free_name(name: str, columns: list[str]) -> str:
    """``name``, with underscores before it as long as a column is called so (names differ by more than case)."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name = "_" + name
    return name


#: Steps of a doubling in which counts are binned.
STEPS = 16


def frequent(table: DataFrame, n: str, most: int) -> DataFrame:
    """The rows of the largest counts ``n``, at most ``most`` of them.

    The cut-off comes from counts of binned counts (at most some thousand rows), so the rows under it stay
    where they are; the bin that would go over ``most`` is left out whole.
    """
    step = F.floor(F.log2(n) * STEPS)
    bins = sorted(((r[0], r[1]) for r in table.groupBy(step.alias("bin")).agg(F.count(F.lit(1))).collect()), reverse=True)
    cut, held = None, 0
    for at, rows in bins:
        held += rows
        if held > most:
            break
        cut = at
    return table.filter(F.lit(False)) if cut is None else table.filter(step >= cut)


def top_rows(table: DataFrame, n: str, key: str, most: int) -> list:
    """The ``most`` rows of the largest counts ``n``, ties by ``key``, in that order.

    Beyond the rows that ``frequent`` finds, the counts of counts of the next bin give the last count; only rows of it
    and over it come to the driver.
    """
    sure = frequent(table, n, most)
    rows = sure.collect()
    least = min((r[n] for r in rows), default=None)
    rest = table if least is None else table.filter(F.col(n) < least)
    top = rest.agg(F.max(F.floor(F.log2(n) * STEPS))).first()[0]
    left = most - len(rows)
    if top is not None and left > 0:
        rest = rest.filter(F.floor(F.log2(n) * STEPS) == top)
        counts = sorted(((r[0], r[1]) for r in rest.groupBy(n).agg(F.count(F.lit(1))).collect()), reverse=True)
        for value, size in counts:
            own = rest.filter(F.col(n) == value)
            rows += own.collect() if size <= left else own.orderBy(key).limit(left).collect()
            left -= size
            if left <= 0:
                break
    return sorted(rows, key=lambda r: (-r[n], r[key]))


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column without copying it (nulls are empty)."""
    if column.null_count:
        column = column.fill_null("")
    width = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, offsets, data = column.buffers()
    offs = np.frombuffer(offsets, width)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    buf = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return buf, offs


def text_slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Cut a string column into ``(from row, to row, bytes, offsets)`` of about ``limit`` bytes each."""
    if not len(column):
        return
    buf, offs = utf8(column)
    lo = 0
    while lo < len(column):
        hi = int(np.searchsorted(offs, offs[lo] + limit, side="right")) - 1
        hi = min(max(hi, lo + 1), len(column))
        yield lo, hi, buf[offs[lo] : offs[hi]], offs[lo : hi + 1] - offs[lo]
        lo = hi


def batch(schema: pa.Schema, *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def signed(h: np.ndarray) -> np.ndarray:
    return h.view(np.int64)


def lists(values: np.ndarray, offsets: np.ndarray, kind: pa.DataType) -> pa.Array:
    """A list column from flat values and row offsets."""
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, kind))
