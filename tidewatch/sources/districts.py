"""District dimension.

The dimension is a fixed, bounded table (15 rows for one city).  Its size
is known at construction, so it is the one side we broadcast without a
runtime check; user-supplied dimensions go through
``tidewatch.operators.joins.attach_dimension`` which checks the size first.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

CITY = "Surabaya"

# ---- fixed values: must equal the reference's district attributes --------
# name, elevation m, drainage capacity m3/s, area km2, population,
# runoff coefficient, coast distance km, historical flood frequency
DISTRICT_ROWS = [
    ("Benowo", 3.2, 15.0, 24.8, 72541, 0.65, 12.5, 8),
    ("Pakal", 4.1, 18.0, 22.5, 63218, 0.60, 15.2, 6),
    ("Tandes", 5.0, 22.0, 9.7, 108432, 0.72, 8.3, 10),
    ("Lakarsantri", 8.5, 35.0, 18.4, 57819, 0.45, 20.1, 3),
    ("Wonokromo", 6.2, 28.0, 8.5, 143265, 0.80, 9.8, 12),
    ("Rungkut", 9.8, 40.0, 21.1, 95847, 0.70, 18.5, 4),
    ("Sukolilo", 7.3, 32.0, 23.5, 87631, 0.65, 14.2, 5),
    ("Kenjeran", 2.8, 12.0, 7.6, 75234, 0.75, 1.2, 15),
    ("Bulak", 2.5, 10.0, 6.8, 42187, 0.78, 0.8, 18),
    ("Semampir", 3.5, 14.0, 8.9, 132541, 0.82, 2.1, 14),
    ("Bubutan", 4.2, 20.0, 4.8, 98765, 0.85, 6.5, 9),
    ("Simokerto", 4.8, 18.0, 5.3, 112340, 0.83, 4.3, 11),
    ("Sawahan", 5.1, 24.0, 9.1, 187654, 0.78, 7.8, 10),
    ("Genteng", 6.0, 26.0, 4.3, 76543, 0.80, 8.9, 7),
    ("Gubeng", 5.5, 30.0, 7.8, 145231, 0.75, 10.2, 8),
]
# ---------------------------------------------------------------------------

DISTRICT_SCHEMA = T.StructType([
    T.StructField("location", T.StringType(), False),
    T.StructField("district", T.StringType(), False),
    T.StructField("elevation_m", T.DoubleType(), False),
    T.StructField("drainage_m3s", T.DoubleType(), False),
    T.StructField("area_km2", T.DoubleType(), False),
    T.StructField("population", T.LongType(), False),
    T.StructField("runoff_coef", T.DoubleType(), False),
    T.StructField("coast_km", T.DoubleType(), False),
    T.StructField("flood_freq", T.LongType(), False),
    T.StructField("district_code", T.IntegerType(), False),
])

# The dimension's row count is fixed by construction.
DISTRICT_COUNT = len(DISTRICT_ROWS)


def district_codes(names=None) -> dict[str, int]:
    """M1: alphabetical label codes (what a sorted label encoder assigns)."""
    names = names or [r[0] for r in DISTRICT_ROWS]
    return {n: i for i, n in enumerate(sorted(names))}


def districts(spark: SparkSession, location: str = CITY) -> DataFrame:
    """The district dimension as an inline (JVM-side) VALUES relation."""
    codes = district_codes()
    rows = ", ".join(
        f"('{location}', '{n}', {e!r}D, {c!r}D, {a!r}D, {p}L, {k!r}D, {s!r}D, {f}L, {codes[n]})"
        for (n, e, c, a, p, k, s, f) in DISTRICT_ROWS)
    cols = ", ".join(f.name for f in DISTRICT_SCHEMA.fields)
    return spark.sql(f"SELECT * FROM VALUES {rows} AS d({cols})")


def districts_sql_values(location: str = CITY) -> str:
    """The same dimension as a DuckDB/ANSI ``VALUES`` body with DOUBLE casts."""
    codes = district_codes()
    lines = []
    for (n, e, c, a, p, k, s, f) in DISTRICT_ROWS:
        lines.append(
            f"('{location}', '{n}', {e!r}::DOUBLE, {c!r}::DOUBLE, {a!r}::DOUBLE, "
            f"{p}::BIGINT, {k!r}::DOUBLE, {s!r}::DOUBLE, {f}::BIGINT, {codes[n]}::INTEGER)")
    cols = ", ".join(f.name for f in DISTRICT_SCHEMA.fields)
    return f"SELECT * FROM (VALUES {', '.join(lines)}) AS d({cols})"
