"""Report text and result documents.

Numbers are rounded with ``rint`` before formatting (N4), then placed in a
template per line by ``concat``, which stays in generated code.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.functions.numeric import r1
from tidewatch.functions.text import fixed, template, thousands
from tidewatch.operators.ranking import rank_within, top_k

# ---- fixed values: text templates and display units of the reference ------
RECOMMENDATION_TEMPLATE = (
    "**%d. %s** — Flood Risk Score `%s` (%s)  \n"
    "Genangan estimasi **%s m**, **%s%%** luas wilayah terendam, "
    "**%s jiwa** terdampak, lead time peringatan **%d jam**.")
TOP5_NOTE_TEMPLATE = "%s jiwa | %s%% wilayah | %d jam"
LINE_SEPARATOR = "\n\n"
# column -> (decimals, unit suffix); decimals None means an integer
DISPLAY_UNITS = {
    "Probabilitas (%)": (2, " %"),
    "Tinggi Genangan (m)": (2, " m"),
    "Luas Terdampak (km2)": (2, " km²"),
    "% Luas Terdampak": (1, " %"),
    "Penduduk Terdampak": (None, " jiwa"),
    "Flood Risk Score": (1, ""),
}
# columns of the detail table, in order
DISPLAY_COLUMNS = ["Kecamatan", "Status", "Probabilitas (%)", "Tinggi Genangan (m)", "Luas Terdampak (km2)",
                   "% Luas Terdampak", "Penduduk Terdampak", "Lead Time (jam)", "Flood Risk Score", "Prioritas Evakuasi"]
# ---------------------------------------------------------------------------


def recommendation_line(rank="rank") -> F.Column:
    """one recommendation line of a ranked result row."""
    return template(
        RECOMMENDATION_TEMPLATE, F.col(rank), F.col("district"), fixed("risk_score", 1),
        F.col("priority"), fixed("depth_m", 2), fixed("pct_area_r1", 0),
        thousands("people_affected"), F.col("lead_time_h"))


def top5_note() -> F.Column:
    """the annotation next to each top-5 bar."""
    return template(TOP5_NOTE_TEMPLATE, thousands("people_affected"),
                    fixed("pct_area_r1", 0), F.col("lead_time_h"))


def priority_order():
    """Composite score descending; ties by probability, then district name
    (``district_code`` is the alphabetical code, an integer sort key)."""
    return [F.col("risk_score").desc(), F.col("probability").desc(), F.col("district_code").asc()]


def top5_priority(risk: DataFrame, by=("scenario_id",), k: int = 5) -> DataFrame:
    """O4 + W1 + F20: the k districts with the highest composite score; the
    chart shows them ascending, so ``chart_position`` 1 is the lowest."""
    top = top_k(risk, list(by), priority_order(), k)
    return top.select(*by, "rank", (F.lit(k + 1) - F.col("rank")).alias("chart_position"),
                      F.col("district"), F.col("risk_score"), top5_note().alias("note"))


def top3_recommendations(risk: DataFrame, by=("scenario_id",), k: int = 3) -> DataFrame:
    """O5 + F17-F19 + A14: the k highest-scored districts as numbered text
    lines joined by a blank line, one text per scenario.  A group holds at
    most k lines."""
    top = top_k(risk, list(by), priority_order(), k)
    lines = top.select(*by, F.struct("rank", recommendation_line().alias("line")).alias("l"))
    agg = lines.groupBy(*by).agg(F.array_sort(F.collect_list("l")).alias("ls"))
    return agg.select(*by, F.array_join(F.transform("ls", lambda x: x.getField("line")),
                                        LINE_SEPARATOR).alias("recommendation"))


def display_table(result: DataFrame, by=("scenario_id",)) -> DataFrame:
    """the whole detail table, numbers as display strings with units,
    with its ``position`` (from 1): highest probability first, then by name."""
    def cell(c):
        if c not in DISPLAY_UNITS:
            return F.col(f"`{c}`")
        places, unit = DISPLAY_UNITS[c]
        num = F.col(f"`{c}`").cast("string") if places is None else fixed(F.col(f"`{c}`"), places)
        return F.concat(num, F.lit(unit)).alias(c)

    order = [F.col("`Probabilitas (%)`").desc_nulls_last(), F.col("Kecamatan").asc()]
    return rank_within(result, list(by), order, name="position").select(
        *by, "position", *[cell(c) for c in DISPLAY_COLUMNS])


def result_documents(scored: DataFrame, *, by: str = "scenario_id", analysed_at=None) -> DataFrame:
    """S13 + A13: one nested document per scenario: analysis time, the
    reference weather, and the district results ordered by probability
    (descending, ties by name).  ``scored`` is the output of ``score``; the
    weather fields travel with every row, so no join back is needed.  A
    document holds one entry per district (bounded by the dimension)."""
    prob = r1(F.col("probability"))
    entry = F.struct(
        (-prob).alias("_k1"), F.col("district").alias("_k2"),
        F.col("district").alias("Kecamatan"), F.col("status").alias("Status"),
        prob.alias("Probabilitas"), F.col("depth_m").alias("Tinggi_Genangan_m"),
        F.col("people_affected").alias("Penduduk_Terdampak"),
        F.col("lead_time_h").alias("Lead_Time_jam"))
    weather = F.struct(F.col("observed_text").alias("waktu"),
                       F.col("rain_mm").cast("double").alias("curah_hujan"),
                       F.col("temp_c").cast("double").alias("suhu"),
                       F.col("wind_ms").cast("double").alias("angin"))
    # the weather is the same on all rows of a scenario: carry it with
    # any_value instead of widening the grouping key
    per = scored.groupBy(by).agg(F.any_value(weather).alias("_w"),
                                 F.array_sort(F.collect_list(entry)).alias("_rows"))
    ts = analysed_at if analysed_at is not None else F.current_timestamp()
    return per.select(
        by,
        F.struct(
            F.date_format(ts, "yyyy-MM-dd HH:mm:ss").alias("timestamp_analisis"),
            F.col("_w").alias("cuaca_referensi"),
            F.transform("_rows", lambda r: r.dropFields("_k1", "_k2")).alias("prediksi_kecamatan"),
        ).alias("document"))
