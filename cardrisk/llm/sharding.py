"""K-d tree sharding by weight, with DataFrame operations only.

Documents are points in their metadata (integers, dates and times as they are; strings, decimals and
floating point numbers by their rank among the different values).  A node that is to hold ``k`` shards is split along
its widest dimension (range in the node over range in the table), at
the weighted quantile that gives ``k // 2`` shards' share of the bytes to one
side, until every leaf is one shard.

The quantile is exact and distributed: bytes are summed by 16-bit digits of
the value and the digit that crosses the share is refined.  Equal values are split the same way by a
hash of ``doc_id`` and text, and equal rows by their number in the written table, so no common value, id or
text tips a shard.  A pass sends one row for each node to the driver.  Leaves differ by about one document.

Places in a shard are numbered by hash buckets: counts of the buckets, summed up, give each
bucket's first place, so no shard is gathered in one task.

Nulls and edges: a null text has no bytes (size 1); null metadata stands before
all values; ids may be null, repeated or any 64-bit number; repeated rows are placed each; integers whose range
goes beyond 61 bits are compared without their last bits; other columns are not read, whatever their names;
only the length and the hash of a very long text are used; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cardrisk.llm.common import prepare, written

SHARDS, DIGIT = 8, 16


#: Bits of a coordinate and of a tie's hash, so that no sum of two leaves a long.
BITS = 61


def _ranks(docs: DataFrame, name: str) -> DataFrame:
    """The different values of a column with their rank from 0, by range partitions; no value is gathered with all others."""
    values = docs.select(F.col(name).alias("value")).filter(F.col(name).isNotNull()).distinct()
    laid = written(values.repartitionByRange("value").withColumn("part", F.spark_partition_id()), "shard-values")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row a partition
    offsets = laid.groupBy("part").agg(F.count(F.lit(1)).alias("n")).select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    nth = F.row_number().over(Window.partitionBy("part").orderBy("value"))
    return laid.withColumn("nth", nth).join(offsets, "part").select("value", (F.col("before") + F.col("nth") - 1).alias("rank"))


def _number(kind: T.DataType, c: Column) -> Column | None:
    """A column as a long in its own order, None where only its rank is one."""
    if isinstance(kind, (T.IntegralType, T.BooleanType)):
        return c.cast("bigint")
    if isinstance(kind, T.DateType):
        return F.unix_date(c).cast("bigint")
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(c.cast("timestamp"))
    return None


def points(docs: DataFrame, dimensions: list[str]) -> DataFrame:
    """``doc_id, size, text_crc32, tie, d0, d1, ...``: all that the tree needs of a document."""
    body = F.coalesce(F.col("text"), F.lit(""))
    numbers = [_number(docs.schema[d].dataType, F.col(d)) for d in dimensions]
    found = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), (F.octet_length(body).cast("bigint") + 1).alias("size"), F.crc32(body.cast("binary")).alias("text_crc32"),
        F.pmod(F.xxhash64("doc_id", body), F.lit(1 << BITS)).alias("tie"),
        *[(F.col(d) if x is None else x).alias(f"d{i}") for i, (d, x) in enumerate(zip(dimensions, numbers))],
    )
    for i, (d, x) in enumerate(zip(dimensions, numbers)):
        if x is None:  # few different values are broadcast, many join with common ones split, as Spark measures them
            ranks = _ranks(docs, d)
            found = found.join(ranks, F.col(f"d{i}") == F.col("value"), "left").drop("value", f"d{i}").withColumnRenamed("rank", f"d{i}")
    return found


def _rows(spark, columns: list[str], rows: list[tuple]) -> DataFrame:
    """A row a node, as literals in the plan."""
    each = [F.struct(*[F.lit(v).cast("double" if c == "want" else "bigint").alias(c) for c, v in zip(columns, r)]) for r in rows]
    return spark.range(1).select(F.inline(F.array(*each)))


def _quantiles(df: DataFrame, nodes: dict[int, dict], column: Column) -> None:
    """Narrow each node's ``[lo, lo + 2**bits)`` of the column to the value that crosses its ``want`` bytes."""
    while any(n["bits"] for n in nodes.values()):
        # at most the number of shards
        state = _rows(df.sparkSession, ["node", "lo", "hi", "shift", "want", "dim", "cut", "cut_tie"], [
            (k, n["lo"], n["lo"] + (1 << n["bits"]) - 1, max(n["bits"] - DIGIT, 0), n["want"], n["dim"], n.get("cut"), n.get("cut_tie")) for k, n in nodes.items() if n["bits"]
        ])
        rows = df.join(F.broadcast(state), "node").withColumn("x", column)
        inside = rows.filter((F.col("x") >= F.col("lo")) & (F.col("x") <= F.col("hi")))
        sums = inside.groupBy("node", F.expr("shiftrightunsigned(x - lo, cast(shift as int))").alias("digit"), "want").agg(F.sum("size").alias("bytes"))
        order = Window.partitionBy("node").orderBy("digit")
        sums = sums.withColumn("upto", F.sum("bytes").over(order))
        crossing = sums.filter((F.col("upto") >= F.col("want")) & (F.col("upto") - F.col("bytes") < F.col("want")))
        for r in crossing.select("node", "digit", (F.col("upto") - F.col("bytes")).alias("before")).collect():
            n = nodes[r["node"]]
            shift = max(n["bits"] - DIGIT, 0)
            n["lo"] += r["digit"] << shift
            n["want"] -= r["before"]
            n["bits"] = shift


def kd_shards(docs: DataFrame, dimensions: list[str] | None = None, shards: int = SHARDS, target_bytes: int | None = None) -> DataFrame:
    """``doc_id, size, text_crc32, shard, slot``; with ``target_bytes`` as many shards as that takes."""
    spark = prepare(docs.sparkSession, python=False)
    dimensions = dimensions or [c for c in ("source", "lang", "n_chars", "doc_id") if c in docs.columns]
    dims = [f"d{i}" for i in range(len(dimensions))]
    table = written(points(docs, dimensions).withColumn("row", F.monotonically_increasing_id()), "shard-points")
    ends = [f(c).alias(f"{f.__name__}_{c}") for c in (*dims, "row") for f in (F.min, F.max)]
    whole = table.agg(F.sum("size").alias("bytes"), *ends).first()
    if target_bytes:
        shards = max(1, -(-(whole["bytes"] or 0) // target_bytes))
    # a coordinate counts from the least value (1; nulls are 0); the last bits of a range beyond BITS go
    shifts = {d: max((whole[f"max_{d}"] - whole[f"min_{d}"]).bit_length() - BITS + 1, 0) if whole[f"max_{d}"] is not None else 0 for d in dims}
    least = {d: (whole[f"min_{d}"] or 0) >> shifts[d] for d in dims}
    widths = {d: max(((whole[f"max_{d}"] or 0) >> shifts[d]) - least[d] + 1, 1) for d in dims}
    at = {d: F.coalesce(F.shiftright(d, shifts[d]) - F.lit(least[d]) + 1, F.lit(0).cast("bigint")) for d in dims}
    table = table.select(F.lit(0).cast("long").alias("node"), "doc_id", "size", "text_crc32", "tie", "row", *[at[d].alias(d) for d in dims])
    rows_bits = max(whole["max_row"] or 0, 1).bit_length()

    leaves = {0: shards}  # shards that each open node is to hold; a node is numbered by its first shard
    while any(k > 1 for k in leaves.values()):
        sizes = table.groupBy("node").agg(F.sum("size").alias("bytes"), *[f(d).alias(f"{f.__name__}_{d}") for d in dims for f in (F.min, F.max)])
        nodes: dict[int, dict] = {}
        for r in sizes.collect():  # one row for each node
            if (k := leaves[r["node"]]) > 1:
                wide = max(range(len(dims)), key=lambda i: ((r[f"max_{dims[i]}"] - r[f"min_{dims[i]}"]) / widths[dims[i]], -i))
                lo, hi = r[f"min_{dims[wide]}"], r[f"max_{dims[wide]}"]
                nodes[r["node"]] = {"dim": wide, "lo": lo, "bits": (hi - lo).bit_length(), "want": r["bytes"] * (k // 2) / k}
        if nodes:
            value = F.element_at(F.array(*dims), F.col("dim").cast("int") + 1)
            _quantiles(table, nodes, value)
            for n in nodes.values():
                n |= {"cut": n["lo"], "lo": 0, "bits": BITS}
            _quantiles(table, nodes, F.when(value == F.col("cut"), F.col("tie")))
            for n in nodes.values():
                n |= {"cut_tie": n["lo"], "lo": 0, "bits": rows_bits}
            _quantiles(table, nodes, F.when((value == F.col("cut")) & (F.col("tie") == F.col("cut_tie")), F.col("row")))
            cuts = _rows(spark, ["node", "dim", "cut", "cut_tie", "cut_row", "right"], [(k, n["dim"], n["cut"], n["cut_tie"], n["lo"], k + leaves[k] // 2) for k, n in nodes.items()])
            value = F.element_at(F.array(*dims), F.col("dim").cast("int") + 1)
            tied = (value == F.col("cut")) & (F.col("tie") == F.col("cut_tie"))
            beyond = (value > F.col("cut")) | ((value == F.col("cut")) & (F.col("tie") > F.col("cut_tie"))) | (tied & (F.col("row") > F.col("cut_row")))
            table = table.join(F.broadcast(cuts), "node", "left").withColumn("node", F.when(beyond, F.col("right")).otherwise(F.col("node"))).select("node", "doc_id", "size", "text_crc32", "tie", "row", *dims)
            table = written(table, "shard-nodes")
        split = {}
        for k, n in leaves.items():
            split |= {k: n // 2, k + n // 2: n - n // 2} if n > 1 else {k: n}
        leaves = split

    buckets = int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    table = table.withColumn("bucket", F.pmod(F.xxhash64("tie", "row"), F.lit(buckets)))
    counts = table.groupBy("node", "bucket").agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.partitionBy("node").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1))
    offsets = counts.select("node", "bucket", F.coalesce(before, F.lit(0)).alias("before"))
    nth = F.row_number().over(Window.partitionBy("node", "bucket").orderBy("doc_id", "text_crc32", "row"))
    placed = table.withColumn("nth", nth).join(offsets, ["node", "bucket"])
    return placed.select("doc_id", "size", "text_crc32", F.col("node").cast("int").alias("shard"), (F.col("before") + F.col("nth") - 1).alias("slot"))
