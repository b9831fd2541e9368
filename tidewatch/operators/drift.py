"""Nested report documents whose fields drift.

A fixed schema loses fields that were added, and reads a field that changed its
type as missing.  Here a document is a VARIANT: known fields are read by path and
cast, whatever type they arrived in, and a table of the fields and types that
reports really hold shows what a schema would miss.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: output column, path inside a report, type
FIELDS = [("pkey", "$.properties.pkey", "string"), ("created_at", "$.properties.created_at", "string"),
          ("source", "$.properties.source", "string"), ("status", "$.properties.status", "string"),
          ("flood_depth", "$.properties.tags.flood_depth", "bigint"),
          ("kecamatan", "$.properties.tags.kecamatan", "string"), ("text", "$.properties.text", "string"),
          ("lon", "$.geometry.coordinates[0]", "double"), ("lat", "$.geometry.coordinates[1]", "double")]


def reports(docs: DataFrame, json_col: str = "json", out: str = "report") -> DataFrame:
    """One VARIANT row per report; the other columns are kept.  Text that is no
    JSON, and documents without a list of reports, have none."""
    found = F.try_variant_get(F.try_parse_json(F.col(json_col)), "$.result.objects.output.geometries", "array<variant>")
    return docs.select(*[c for c in docs.columns if c not in (json_col, out)], F.explode(found).alias(out))


def flatten(rows: DataFrame, report_col: str = "report") -> DataFrame:
    """P13 by path: the columns of FIELDS.  A field that is missing, or whose
    value can't be cast, is null; a number sent as text is read as the number."""
    keep = [c for c in rows.columns if c != report_col]
    return rows.select(*keep, *[F.try_variant_get(F.col(report_col), path, kind).alias(name) for name, path, kind in FIELDS])


def field_types(rows: DataFrame, report_col: str = "report") -> DataFrame:
    """(field, type, n): how many reports hold a property, or a tag, with a value of
    a type.  Objects count as such and their members one by one; one pass, counts
    are pre-aggregated in each task."""
    def members(path: str, prefix: str) -> Column:
        return F.struct(F.lit(prefix).alias("prefix"), F.try_variant_get(F.col(report_col), path, "variant").alias("object"))

    both = F.array(members("$.properties", ""), members("$.properties.tags", "tags."))
    each = rows.select(F.explode(both).alias("m")).select("m.prefix", "m.object")
    each = each.lateralJoin(rows.sparkSession.tvf.variant_explode(F.col("object").outer())).where("key is not null")
    return each.select(F.concat("prefix", "key").alias("field"),
                       F.regexp_extract(F.schema_of_variant("value"), "^[A-Z]+", 0).alias("type")) \
        .groupBy("field", "type").agg(F.count(F.lit(1)).alias("n"))
