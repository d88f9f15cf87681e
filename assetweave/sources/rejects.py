"""CSV with a schema, and the lines that don't fit it (S1, S6).

One read: a line that doesn't fit keeps its text, and the parsed table is written
once with it, so rows, rejects and the audit all come from the same pass. A reject has its
file, its text and a reason: too few or too many fields, or the first column whose
text doesn't parse.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assetweave.session import stored

LINE, FILE = "_line", "_file"


@dataclass
class CsvRead:
    """What a read gave: ``rows`` that fit, ``rejects`` (file, line, reason), and both in one written table."""

    parsed: DataFrame
    rows: DataFrame
    rejects: DataFrame


def read_csv_checked(spark: SparkSession, path: str, schema: T.StructType, sep: str = ",", header: bool = True) -> CsvRead:
    """Rows of ``schema`` and the lines that don't fit it. Empty fields are NULL and fit."""
    given = T.StructType([*schema.fields, T.StructField(LINE, T.StringType())])
    read = spark.read.schema(given).option("header", header).option("sep", sep)
    parsed = read.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", LINE).csv(path)
    names = [f.name for f in schema.fields]
    parsed = stored(parsed.select(*names, LINE, F.col("_metadata.file_path").alias(FILE)), "parsed-csv")
    bad = parsed.where(F.col(LINE).isNotNull())
    rejects = bad.select(FILE, F.col(LINE).alias("line"), reason(F.col(LINE), schema, sep).alias("reason"))
    return CsvRead(parsed, parsed.where(F.col(LINE).isNull()).select(*names), rejects.withColumnRenamed(FILE, "file"))


def reason(line: Column, schema: T.StructType, sep: str = ",") -> Column:
    """Why a line doesn't fit."""
    n = len(schema.fields)
    texts = ", ".join(f"`{f.name}` string" for f in schema.fields)
    fields = F.from_csv(line, texts, {"sep": sep})
    # separators inside quotes don't count
    bare = F.regexp_replace(line, r'"(?:[^"]|"")*"', "q")
    count = F.length(bare) - F.length(F.replace(bare, F.lit(sep), F.lit(""))) + 1
    found = F.when(count != n, F.concat(F.lit("fields: "), count.cast("string")))
    for f in schema.fields:
        text = fields[f.name]
        if isinstance(f.dataType, T.StringType):
            continue
        broken = text.isNotNull() & (text != "") & text.try_cast(f.dataType).isNull()
        found = found.when(broken, F.lit(f"not a {f.dataType.simpleString()}: {f.name}"))
    return found.otherwise("other")


def audit(read: CsvRead) -> DataFrame:
    """(reason, n): lines that fit, under "ok", and rejects by reason."""
    fine = read.rows.agg(F.lit("ok").alias("reason"), F.count(F.lit(1)).alias("n"))
    return fine.unionByName(read.rejects.groupBy("reason").agg(F.count(F.lit(1)).alias("n")))
