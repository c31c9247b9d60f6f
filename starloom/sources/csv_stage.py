"""Land an extract as a delimited file and bulk-load it with a fixed schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

DATE_FORMAT = "yyyy-MM-dd"


def write_extract(df: DataFrame, path: str) -> None:
    """Header CSV, ISO dates; one file per task (no single-writer funnel)."""
    df.write.mode("overwrite").option("header", True).option("dateFormat", DATE_FORMAT).csv(path)


def read_extract(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Load by the declared schema.

    ``enforceSchema=False`` makes the header names line up with the schema
    (a reordered extract is refused); FAILFAST refuses unparsable values.
    Empty required fields become NULL, which :func:`missing_required`
    reports.
    """
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("enforceSchema", False)
        .option("dateFormat", DATE_FORMAT)
        .option("mode", "FAILFAST")
        .csv(path)
    )


def missing_required(df: DataFrame, schema: T.StructType) -> int:
    """Rows with a NULL in a non-nullable column (one pass)."""
    required = [f.name for f in schema.fields if not f.nullable]
    if not required:
        return 0
    cond = F.lit(False)
    for c in required:
        cond = cond | F.col(c).isNull()
    return int(df.agg(F.count_if(cond).alias("n")).first()["n"])
