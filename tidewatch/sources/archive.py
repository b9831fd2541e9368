"""Archive and snapshot readers.

All readers pass an explicit schema: inference costs a full pass over the
archive and drifts between long and double.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch import schemas as S

CORRUPT = "_corrupt_record"


def read_weather_archive(spark: SparkSession, path_glob: str, view: str | None = None,
                         schema: T.StructType | None = None) -> DataFrame:
    """S1 + S2: every archived weather JSON file under a glob, optionally
    registered as a SQL view.  An absent archive has no rows (P7), malformed
    records are left out."""
    df = read_tolerant(spark, path_glob, schema or S.WEATHER_EVENT)
    if view:
        df.createOrReplaceTempView(view)
    return df


def read_tolerant(spark: SparkSession, path: str, schema: T.StructType, *,
                  multiline: bool = False) -> DataFrame:
    """Absent or malformed input is "no data", not a failure.

    Malformed records are left out (``read_split`` returns them too); a
    missing path yields an empty DataFrame with the schema."""
    return read_split(spark, path, schema, multiline=multiline)[0]


def read_split(spark: SparkSession, path: str, schema: T.StructType, *,
               multiline: bool = False) -> tuple[DataFrame, DataFrame]:
    """Rows and malformed records (schema plus the raw text) of one permissive
    read; both are empty when the path is absent."""
    full = T.StructType(schema.fields + [T.StructField(CORRUPT, T.StringType())])
    try:
        text = spark.read.text(path, wholetext=multiline)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        text = spark.createDataFrame([], "value string")
    parsed = F.from_json("value", full, {"columnNameOfCorruptRecord": CORRUPT})
    df = text.where(F.trim("value") != "").select(parsed.alias("r")).select("r.*")
    good = F.col(CORRUPT).isNull()
    return df.where(good).drop(CORRUPT), df.where(~good)


def read_rejects(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The malformed records of a JSON input, for a reject report."""
    return read_split(spark, path, schema)[1]


def read_weather_snapshot(spark: SparkSession, path: str) -> DataFrame:
    """S3: newest weather snapshot (0 or 1 row)."""
    return read_tolerant(spark, path, S.WEATHER_EVENT)


def read_report_snapshot(spark: SparkSession, path: str) -> DataFrame:
    """S4 + S14: newest nested report document (multi-line JSON)."""
    return read_tolerant(spark, path, S.REPORT_DOCUMENT, multiline=True)


def parse_report_documents(df: DataFrame, json_col: str, out: str = "doc") -> DataFrame:
    """Parse nested report documents held as JSON text."""
    return df.withColumn(out, F.from_json(F.col(json_col), S.REPORT_DOCUMENT))
