"""SQL text fragments for the DuckDB oracle (``__spark_entry__.oracle_sql``).

These restate the Column expressions of ``tidewatch.operators`` in ANSI SQL
with DuckDB spellings (``round_even`` for ``rint``, explicit DOUBLE literals,
``trunc`` before BIGINT casts).  They exist only to check the Spark plans, and
state labels, bands, weights, thresholds and display formats as literals of
their own: a changed constant in the package then fails the comparison.
"""

from __future__ import annotations

import math

from tidewatch.operators import hydrology as H
from tidewatch.sources.districts import CITY, districts_sql_values


def D(x: float) -> str:
    return f"{float(x)!r}::DOUBLE"


def clip(x: str, lo, hi) -> str:
    lo_s = lo if isinstance(lo, str) else D(lo)
    hi_s = hi if isinstance(hi, str) else D(hi)
    return f"LEAST(GREATEST({x}, {lo_s}), {hi_s})"


def rnd(x: str, places: int) -> str:
    s = D(10 ** places)
    return f"(round_even(({x}) * {s}, 0) / {s})"


def r0(x: str) -> str:
    return f"CAST(round_even({x}, 0) AS INTEGER)"


def pos(x: str) -> str:
    return f"GREATEST({D(0.0)}, {x})"


def trunc_long(x: str) -> str:
    return f"CAST(trunc({x}) AS BIGINT)"


def sq(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


DISTRICTS = districts_sql_values()


def minute_text(ts: str) -> str:
    return f"strftime({ts}, '%Y-%m-%dT%H:%M')"


# Weather events bound from `events` (mirrors testbind.weather_events).
WEATHER = f"""
SELECT event_id, ts AS event_time, {minute_text('ts')} AS "timestamp",
       24 + (event_id % 121) / 10 AS suhu_c,
       55 + user_id % 46 AS kelembaban_pct,
       value / 10 AS curah_hujan_mm,
       ({D(3.6)} + user_id % 100) / {D(3.6)} AS kecepatan_angin_ms,
       '{CITY}' AS lokasi,
       CAST(1 + event_id % 12 AS INTEGER) AS month
FROM events"""

SCENARIOS = f"""
SELECT event_id AS scenario_id, lokasi AS location, "timestamp" AS observed_text,
       curah_hujan_mm AS rain_mm, kelembaban_pct AS humidity_pct, suhu_c AS temp_c,
       kecepatan_angin_ms AS wind_ms, month,
       CAST(NULL AS DOUBLE) AS rain_3day_mm, CAST(NULL AS DOUBLE) AS sunshine_h
FROM ({WEATHER}) w"""


def tide_base(variant: H.Variant) -> str:
    if not variant.seasonal_tide:
        return D(0.8)
    return f"({D(0.8)} + {D(0.4)} * sin({D(2 * math.pi)} * month / {D(12.0)}))"


def scored(scenarios_sql: str, variant: H.Variant, probability: str | None = None, districts: str = DISTRICTS) -> str:
    """Scenario x district rows with every hydrology column (mirrors scoring.score)."""
    tb = tide_base(variant)
    wet = "11, 12, 1, 2, 3, 4"
    depth_floor, area_floor = (0.05, 0.1) if variant.seasonal_tide else (0.0, 0.0)
    extra = ""
    if variant.seasonal_tide:
        extra = (f", CAST(month IN ({wet}) AS INTEGER) AS wet_season"
                 f", GREATEST(0, {r0(f'({D(8.0)} - sunshine_h) * LEAST(rain_mm / {D(20.0)}, {D(1.0)})')})"
                 f" AS rain_duration_h")
    prob = probability or "index_prob"
    return f"""
WITH sd AS (SELECT s.*, d.* EXCLUDE (location) FROM ({scenarios_sql}) s JOIN ({districts}) d USING (location)),
h1 AS (SELECT *,
  {pos(f'{tb} - coast_km * {D(0.05)}')} AS tide_m,
  runoff_coef * (rain_mm / {D(3600.0)}) * area_km2 * {D(1000.0)} AS runoff_m3s,
  {rnd(clip(f'rain_mm / {D(25.0)} * ({D(1.0)} + ({D(5.0)} - elevation_m) / {D(5.0)})', 0.2, 5.0), 2)} AS river_stage_m,
  GREATEST(1, {r0(f'{D(12.0)} - rain_mm / {D(20.0)} - ({D(5.0)} - elevation_m) * {D(0.5)}')}) AS lead_time_h
  FROM sd),
h2 AS (SELECT *, {pos('runoff_m3s - drainage_m3s')} AS excess_m3s FROM h1),
h3 AS (SELECT *, {rnd(clip(f'(excess_m3s / drainage_m3s) * {D(0.5)} + tide_m * {D(0.3)} + ({D(5.0)} - elevation_m) * {D(0.1)}', depth_floor, 3.0), 2)} AS depth_m FROM h2),
h4 AS (SELECT *, {rnd(clip(f'area_km2 * (depth_m / {D(2.0)}) * {D(0.6)}', area_floor, 'area_km2'), 2)} AS flooded_km2 FROM h3),
h5 AS (SELECT *, {trunc_long('(population / area_km2) * flooded_km2')} AS people_affected,
  LEAST({D(100.0)}, (rain_mm * {D(0.25)} + river_stage_m * {D(0.20)} + ({D(10.0)} - elevation_m) * {D(0.15)}
      + excess_m3s * {D(0.15)} + tide_m * {D(0.10)}) / {D(5.0)} * {D(100.0)}) AS index_prob{extra}
  FROM h4),
h6 AS (SELECT *, {prob} AS probability FROM h5)
SELECT *, CASE WHEN probability > {D(70.0)} THEN '🔴 KRITIS'
               WHEN probability > {D(40.0)} THEN '🟡 WASPADA'
               ELSE '🟢 AMAN' END AS status
FROM h6"""


def risk(scored_sql: str) -> str:
    """Mirrors scoring.add_risk_score."""
    w = [D(x) for x in (0.35, 0.20, 0.15, 0.20, 0.10)]
    return f"""
WITH r1 AS (SELECT *,
  {clip(f'flooded_km2 / area_km2 * {D(100.0)}', 0.0, 100.0)} AS pct_area,
  {clip(f'people_affected / population * {D(100.0)}', 0.0, 100.0)} AS pct_people,
  {clip(f'depth_m / {D(3.0)} * {D(100.0)}', 0.0, 100.0)} AS norm_depth,
  {clip(f'(12 - lead_time_h) / {D(11.0)} * {D(100.0)}', 0.0, 100.0)} AS norm_urgency
  FROM ({scored_sql}) x),
r2 AS (SELECT *, {rnd(f'{w[0]} * probability + {w[1]} * norm_depth + {w[2]} * pct_area + {w[3]} * pct_people + {w[4]} * norm_urgency', 1)} AS risk_score FROM r1)
SELECT *, CASE WHEN risk_score > {D(70.0)} THEN '🔴 PRIORITAS UTAMA'
               WHEN risk_score > {D(40.0)} THEN '🟡 PRIORITAS SEDANG'
               ELSE '🟢 PRIORITAS RENDAH' END AS priority,
       {rnd('pct_area', 1)} AS pct_area_r1
FROM r2"""


def batch_result(scored_sql: str, keep: str = "scenario_id") -> str:
    return f"""
SELECT {keep}, district AS "Kecamatan", status AS "Status", {rnd('probability', 1)} AS "Probabilitas",
       depth_m AS "Tinggi_Genangan_m", people_affected AS "Penduduk_Terdampak",
       lead_time_h AS "Lead_Time_jam"
FROM ({scored_sql}) b"""


def dashboard_result(risk_sql: str, keep: str = "scenario_id") -> str:
    return f"""
SELECT {keep}, district AS "Kecamatan", status AS "Status", probability AS "Probabilitas (%)",
       depth_m AS "Tinggi Genangan (m)", flooded_km2 AS "Luas Terdampak (km2)",
       pct_area_r1 AS "% Luas Terdampak", people_affected AS "Penduduk Terdampak",
       lead_time_h AS "Lead Time (jam)", risk_score AS "Flood Risk Score",
       priority AS "Prioritas Evakuasi"
FROM ({risk_sql}) r"""


def live_proxies(scenarios_sql: str) -> str:
    return f"""
SELECT * REPLACE (COALESCE(rain_3day_mm, rain_mm * {D(1.5)} + {D(20.0)}) AS rain_3day_mm,
                  COALESCE(sunshine_h, CASE WHEN rain_mm > {D(10.0)} THEN {D(4.0)} ELSE {D(8.0)} END) AS sunshine_h)
FROM ({scenarios_sql}) s"""


def band(x: str, hi, lo, higher_is_worse: bool = True) -> str:
    if higher_is_worse:
        return (f"CASE WHEN {x} > {hi} THEN 'danger' WHEN {x} > {lo} THEN 'warn' "
                f"ELSE 'safe' END")
    return f"CASE WHEN {x} <= {hi} THEN 'danger' WHEN {x} <= {lo} THEN 'warn' ELSE 'safe' END"


def fixed(x: str, places: int) -> str:
    return f"printf('%.{places}f', {rnd(x, places)})"


def thousands(x: str) -> str:
    return f"format('{{:,}}', CAST({x} AS BIGINT))"


# What-if scenarios bound from `events` (mirrors testbind.what_if_inputs).
WHAT_IF = f"""
SELECT event_id AS scenario_id, 'Surabaya' AS location, 'Mode Simulasi Manual' AS observed_text,
  CAST(CAST(trunc(value) AS BIGINT) % 201 AS DOUBLE) AS rain_mm,
  CAST(55 + event_id % 46 AS BIGINT) AS humidity_pct,
  24 + (user_id % 121) / 10 AS temp_c,
  1 + (event_id % 291) / 10 AS wind_ms,
  CAST(1 + user_id % 12 AS INTEGER) AS month,
  CAST((user_id * 7 + event_id) % 301 AS DOUBLE) AS rain_3day_mm,
  (event_id % 121) / 10 AS sunshine_h
FROM events"""


def district_name_by_index(expr: str) -> str:
    from tidewatch.sources.districts import DISTRICT_ROWS
    arr = ", ".join(sq(r[0]) for r in DISTRICT_ROWS)
    return f"([{arr}])[{expr}]"


# Daily station weather bound from `lineitem` (mirrors testbind.daily_weather).
DAILY = """
SELECT 'Surabaya' AS location, date, GREATEST(_q % 500 - 100, 0) / 10 AS rain_mm,
       55 + _n % 46 AS humidity_pct, 24 + (_ln % 121) / 10 AS temp_c,
       1 + (_pk % 290) / 10 AS wind_ms, (_sk % 121) / 10 AS sunshine_h
FROM (SELECT CAST(l_shipdate AS DATE) AS date, CAST(sum(l_quantity) AS BIGINT) AS _q,
             count(*) AS _n, CAST(sum(l_linenumber) AS BIGINT) AS _ln,
             CAST(sum(l_partkey) AS BIGINT) AS _pk, max(l_suppkey) AS _sk
      FROM lineitem GROUP BY 1) li"""

FLOOD_DATES = """
SELECT date FROM (
  SELECT CAST(o_orderdate AS DATE) AS date, sum(CAST(o_totalprice AS DECIMAL(18,2))) AS v
  FROM orders WHERE o_orderpriority = '1-URGENT' GROUP BY 1 ORDER BY v DESC, date LIMIT 30) f"""

RAIN3 = f"""
SELECT *, CAST(SUM(CAST(rain_mm AS DECIMAL(30,3))) OVER (PARTITION BY location ORDER BY date
          RANGE BETWEEN INTERVAL 2 DAYS PRECEDING AND CURRENT ROW) AS DOUBLE) AS rain_3day_mm
FROM ({DAILY}) d"""

LABELLED = f"""
SELECT r.*, CASE WHEN f.date IS NULL THEN 0 ELSE 1 END AS confirmed,
       CAST(r.rain_3day_mm > 80.0::DOUBLE OR f.date IS NOT NULL AS INTEGER) AS flood,
       CAST(month(r.date) AS INTEGER) AS month,
       CAST(month(r.date) IN (11, 12, 1, 2, 3, 4) AS INTEGER) AS wet_season
FROM ({RAIN3}) r LEFT JOIN ({FLOOD_DATES}) f ON r.date = f.date"""

MATRIX = f"""
SELECT date, district, rain_mm AS curah_hujan_mm, rain_3day_mm AS curah_hujan_3hari,
  humidity_pct AS kelembaban_pct, temp_c AS suhu_c, wind_ms AS kecepatan_angin,
  GREATEST(0, {r0(f'({D(8.0)} - sunshine_h) * LEAST(rain_mm / {D(20.0)}, {D(1.0)})')}) AS durasi_hujan_jam,
  month AS bulan, wet_season AS musim_hujan, elevation_m AS elevasi_m, runoff_coef AS koef_limpasan,
  flood_freq AS frekuensi_historis, district_code AS kecamatan_enc, flood AS label,
  drainage_m3s, area_km2, population, coast_km
FROM ({LABELLED}) l JOIN ({DISTRICTS}) d USING (location)"""


def index_score(matrix_sql: str) -> str:
    """Mirrors training.index_score (batch tide, river stage, excess)."""
    rain, elev = "curah_hujan_mm", "elevasi_m"
    tide = pos(f"{D(0.8)} - coast_km * {D(0.05)}")
    excess = pos(f"koef_limpasan * ({rain} / {D(3600.0)}) * area_km2 * {D(1000.0)} - drainage_m3s")
    stage = rnd(clip(f"{rain} / {D(25.0)} * ({D(1.0)} + ({D(5.0)} - {elev}) / {D(5.0)})", 0.2, 5.0), 2)
    p = (f"LEAST({D(100.0)}, ({rain} * {D(0.25)} + {stage} * {D(0.20)} + ({D(10.0)} - {elev}) * {D(0.15)}"
         f" + {excess} * {D(0.15)} + {tide} * {D(0.10)}) / {D(5.0)} * {D(100.0)})")
    return f"SELECT *, {p} / {D(100.0)} AS score FROM ({matrix_sql}) m"


def tiles(src_sql: str, n: int) -> str:
    return f"SELECT date, CAST(ntile({n}) OVER (ORDER BY date) AS INTEGER) AS tile FROM (SELECT DISTINCT date FROM ({src_sql}) s) d"


def score_counts_sql(scored_sql: str, by: str | None = None) -> str:
    """Per distinct score: pos, neg and the pos/neg rows with a lower score."""
    b = f"{by}, " if by else ""
    part = f"PARTITION BY {by}" if by else ""
    frame = "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"
    return f"""
SELECT *, CAST(COALESCE(sum(pos) OVER ({part} ORDER BY score {frame}), 0) AS BIGINT) AS pos_below,
          CAST(COALESCE(sum(neg) OVER ({part} ORDER BY score {frame}), 0) AS BIGINT) AS neg_below,
          CAST(sum(pos) OVER ({part}) AS BIGINT) AS "P", CAST(sum(neg) OVER ({part}) AS BIGINT) AS "N"
FROM (SELECT {b}score, CAST(sum(y) AS BIGINT) AS pos, CAST(sum(1 - y) AS BIGINT) AS neg
      FROM ({scored_sql}) s GROUP BY {b}score) c"""


def auc_sql(scored_sql: str, by: str | None = None) -> str:
    """Rank-sum AUC with mid-ranks, in integer arithmetic."""
    b = f"{by}, " if by else ""
    grp = f"GROUP BY {by}" if by else ""
    return f"""
SELECT {b}CAST(sum(pos) AS BIGINT) AS positives, CAST(sum(neg) AS BIGINT) AS negatives,
  CAST(sum(pos * (2 * (pos_below + neg_below) + pos + neg + 1)) - sum(pos) * (sum(pos) + 1) AS DOUBLE)
    / (CAST(2 * sum(pos) AS DOUBLE) * CAST(sum(neg) AS DOUBLE)) AS auc
FROM ({score_counts_sql(scored_sql, by)}) r {grp}"""


# Weather of several cities and the dimension of each (mirrors testbind.city_weather).
CITY_SCENARIOS = SCENARIOS.replace("lokasi AS location", "city AS location").replace(
    "FROM (" + WEATHER + ") w", "FROM (" + WEATHER.replace(" FROM events", "").replace(
        "\nFROM events", ", 'Kota ' || user_id % 4 AS city\nFROM events") + ") w")
CITY_DISTRICTS = " UNION ALL ".join(districts_sql_values(f"Kota {i}") for i in range(4))

# The detail table: ten columns, numbers with their units.
DISPLAY = """
SELECT scenario_id, CAST(row_number() OVER (PARTITION BY scenario_id ORDER BY "Probabilitas (%)" DESC, "Kecamatan") AS INTEGER) AS position,
  "Kecamatan", "Status", printf('%.2f %%', round_even("Probabilitas (%)" * 100.0::DOUBLE, 0) / 100.0::DOUBLE) AS "Probabilitas (%)",
  printf('%.2f m', "Tinggi Genangan (m)") AS "Tinggi Genangan (m)", printf('%.2f km²', "Luas Terdampak (km2)") AS "Luas Terdampak (km2)",
  printf('%.1f %%', "% Luas Terdampak") AS "% Luas Terdampak", printf('%d jiwa', "Penduduk Terdampak") AS "Penduduk Terdampak",
  "Lead Time (jam)", printf('%.1f', "Flood Risk Score") AS "Flood Risk Score", "Prioritas Evakuasi"
FROM ({0}) d"""

# Severity bands: column, danger above, warn above (lead time: at or below).
BANDS = {"probability": ("probability", 70.0, 40.0, True), "depth": ("depth_m", 1.0, 0.5, True),
         "people": ("people_affected", 5000, 1000, True), "lead_time": ("lead_time_h", 3, 6, False),
         "pct_area": ("pct_area_r1", 50.0, 25.0, True), "risk_score": ("risk_score", 70.0, 40.0, True)}

# Recommendation text of the three districts with the highest score.
RECOMMENDATION = ("**%d. %s** — Flood Risk Score `%s` (%s)  \n"
                  "Genangan estimasi **%s m**, **%s%%** luas wilayah terendam, "
                  "**%s jiwa** terdampak, lead time peringatan **%d jam**.")
CLASS_NAMES = ("Tidak Banjir", "Banjir")
THRESHOLD = 0.465

# Rain x month what-if grid (mirrors testbind.rain_month_grid).
RAIN_MONTH_GRID = f"""
SELECT rain * 100 + month AS scenario_id, 'Surabaya' AS location, 'Mode Simulasi Manual' AS observed_text,
  CAST(rain AS DOUBLE) AS rain_mm, CAST(80 AS BIGINT) AS humidity_pct, {D(28.0)} AS temp_c,
  {D(3.0)} AS wind_ms, month, CAST(rain * 3 AS DOUBLE) AS rain_3day_mm, {D(0.0)} AS sunshine_h
FROM (SELECT DISTINCT CAST(trunc(value) AS BIGINT) % 201 AS rain,
             CAST(1 + user_id % 12 AS INTEGER) AS month FROM events) p"""
