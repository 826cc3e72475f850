"""Delimited text with every bad line accounted for (2.A A7, 2.H H3).

A line is a row, or it goes to the reject table with its text, its file and one reason; kept and rejected
lines are all lines of the files.  Reasons, the first that holds: ``blank``, ``header`` (again), ``malformed`` (another number of fields
than the schema, or a value that is not of its type) and ``missing`` (a required field is empty).  A
line is a record: quoted fields may hold separators but no line breaks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cardrisk.schema import METRIC_HISTORY
from cardrisk.sources.readers import TS_FORMAT

_BAD = "_corrupt_record"


def parsed_lines(spark: SparkSession, path, schema: T.StructType = METRIC_HISTORY, required: Sequence[str] | None = None) -> DataFrame:
    """``line, file, record, reason``: every line with its parsed fields; a null reason is a good line.

    ``required`` fields default to the schema's numeric ones.
    """
    required = [f.name for f in schema.fields if isinstance(f.dataType, T.NumericType)] if required is None else required
    lines = spark.read.text(path).select(F.col("value").alias("line"), F.col("_metadata.file_path").alias("file"))
    kind = T.StructType([*schema.fields, T.StructField(_BAD, T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _BAD, "timestampFormat": TS_FORMAT}
    # a field more than the schema's counts as malformed, so the line is also split without types
    fields = F.from_csv("line", ", ".join(f"c{i} string" for i in range(len(schema) + 1)))
    names = F.array(*[F.lit(f.name) for f in schema.fields])
    text = F.array(*[F.trim(fields[f"c{i}"]) for i in range(len(schema))])
    d = lines.withColumn("record", F.from_csv("line", kind.simpleString()[7:-1].replace(":", " "), options)).withColumn("_more", fields[f"c{len(schema)}"].isNotNull())
    missing = F.lit(False)
    for c in required:
        missing = missing | F.col("record")[c].isNull()
    reason = (
        F.when(F.trim("line") == "", "blank").when(text == names, "header")
        .when(F.col("record")[_BAD].isNotNull() | F.col("_more"), "malformed").when(missing, "missing")
    )
    return d.select("line", "file", F.col("record").dropFields(_BAD).alias("record"), reason.alias("reason"))


def good_rows(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col("reason").isNull()).select("record.*")


def rejected(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col("reason").isNotNull()).select("line", "file", "reason")


def split_lines(parsed: DataFrame, good: str, bad: str) -> None:
    """Write the good rows and the reject table; the files are parsed once, into a written table."""
    from cardrisk.session import scratch_path

    spark, path = parsed.sparkSession, scratch_path(parsed.sparkSession, "parsed-lines")
    parsed.write.parquet(path)
    kept = spark.read.schema(parsed.schema).parquet(path)
    good_rows(kept).write.mode("overwrite").parquet(good)
    rejected(kept).write.mode("overwrite").parquet(bad)
