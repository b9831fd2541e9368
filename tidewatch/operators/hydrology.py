"""Hydrology formulas.

Each formula is written once, as a Spark SQL expression built from the SQL
expressions of its inputs (column names by default), and becomes a ``Column``
through ``F.expr``.  Building a formula is then one parse in the JVM instead
of hundreds of Python-to-JVM calls per Column operator, and the plan is the
same whole-stage-codegen projection.

Input columns (scenario x district row):
  rain_mm, month, sunshine_h, rain_3day_mm            (scenario)
  elevation_m, drainage_m3s, area_km2, population,
  runoff_coef, coast_km                               (district)

The operand order of every expression follows the reference formulas so that
double arithmetic is bit-identical to it and to the SQL oracle.  Every
literal is a DOUBLE (``D`` suffix); rounding is ``rint`` (SURVEY N1, N2).
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Variant:
    """The two formula variants of the reference (batch job vs dashboard)."""
    name: str
    seasonal_tide: bool
    depth_floor: float
    area_floor: float


# ---- fixed values: formula variants of the reference ----------------------
BATCH = Variant("batch", seasonal_tide=False, depth_floor=0.0, area_floor=0.0)
DASHBOARD = Variant("dashboard", seasonal_tide=True, depth_floor=0.05, area_floor=0.1)
TIDE_BASE_M = 0.8
TIDE_AMPLITUDE_M = 0.4
TIDE_DECAY_PER_KM = 0.05
WET_SEASON_MONTHS = [11, 12, 1, 2, 3, 4]
# live proxies of rain: 3-day total (factor, offset), sunshine (threshold, wet h, dry h)
RAIN3_PROXY = (1.5, 20.0)
SUNSHINE_PROXY = (10.0, 4.0, 8.0)
# rain duration: daylight hours without rain, rain of a whole day
DURATION = (8.0, 20.0)
# runoff: seconds an hour, mm x km2 to m3
RUNOFF = (3600.0, 1000.0)
# elevations below this one count as low
LOW_ELEVATION_M = 5.0
# river stage: mm a metre, lowest and highest stage
STAGE = (25.0, 0.2, 5.0)
# flood depth: weight of relative excess, tide, metres below LOW_ELEVATION_M; highest depth
DEPTH = (0.5, 0.3, 0.1, 3.0)
# flooded area: depth that floods all of the floodable share
AREA = (2.0, 0.6)
# lead time: hours in dry weather, mm an hour less, hours a metre below LOW_ELEVATION_M
LEAD = (12.0, 20.0, 0.5)
# index: weights of rain, stage, metres below the top elevation, excess, tide; scale
INDEX = (0.25, 0.20, 0.15, 0.15, 0.10)
INDEX_TOP_ELEVATION_M, INDEX_SCALE = 10.0, 5.0
# ---------------------------------------------------------------------------

VARIANTS = {v.name: v for v in (BATCH, DASHBOARD)}


# ---- SQL expression helpers -------------------------------------------------

def d(x: float) -> str:
    """A DOUBLE literal."""
    return f"{float(x)!r}D"


def clip(x: str, lo: str, hi: str) -> str:
    return f"least(greatest({x}, {lo}), {hi})"


def pos(x: str) -> str:
    return f"greatest({d(0.0)}, {x})"


def rnd(x: str, places: int) -> str:
    s = d(10 ** places)
    return f"(rint(({x}) * {s}) / {s})"


def r0(x: str) -> str:
    return f"CAST(rint({x}) AS INT)"


def known(value: str, *inputs: str, nonzero: str | None = None) -> str:
    """``value`` where every input is known, else NULL: ``greatest`` and
    ``least`` skip NULLs and would turn missing rain into the worst case.
    ``nonzero``: a divisor that must not be 0 either (0 gives NULL)."""
    tests = [f"{x} IS NOT NULL" for x in inputs] + ([f"{nonzero} <> {d(0.0)}"] if nonzero else [])
    return f"(CASE WHEN {' AND '.join(tests)} THEN {value} END)"


# ---- formulas (SQL text) -----------------------------------------------------

def rain_3day_proxy(rain: str = "rain_mm") -> str:
    """H1: live 3-day rain proxy ``rr*1.5 + 20``."""
    return f"({rain} * {d(RAIN3_PROXY[0])} + {d(RAIN3_PROXY[1])})"


def sunshine_proxy(rain: str = "rain_mm") -> str:
    """H2: live sunshine proxy, 4 h when ``rr > 10`` else 8 h."""
    over, wet, dry = SUNSHINE_PROXY
    return known(f"CASE WHEN {rain} > {d(over)} THEN {d(wet)} ELSE {d(dry)} END", rain)


def wet_season(month: str = "month") -> str:
    """H3: 1 in the wet-season months."""
    return f"CAST({month} IN ({', '.join(str(m) for m in WET_SEASON_MONTHS)}) AS INT)"


def rain_duration(sunshine: str = "sunshine_h", rain: str = "rain_mm") -> str:
    """H4: ``max(0, round((8 - ss) * min(rr/20, 1)))``."""
    day, full = DURATION
    hours = r0(f"({d(day)} - {sunshine}) * least({rain} / {d(full)}, {d(1.0)})")
    return known(f"greatest(0, {hours})", sunshine, rain)


def tide_base(variant: Variant, month: str = "month") -> str:
    """H5: 0.8 m, or ``0.8 + 0.4*sin(2*pi*month/12)`` in the dashboard."""
    if not variant.seasonal_tide:
        return d(TIDE_BASE_M)
    return f"({d(TIDE_BASE_M)} + {d(TIDE_AMPLITUDE_M)} * sin({d(2 * math.pi)} * {month} / {d(12.0)}))"


def tide_at(base: str, coast_km: str = "coast_km") -> str:
    """H6: ``max(0, base - 0.05*coast_km)``."""
    return known(pos(f"{base} - {coast_km} * {d(TIDE_DECAY_PER_KM)}"), base, coast_km)


def runoff(coef: str = "runoff_coef", rain: str = "rain_mm", area: str = "area_km2") -> str:
    """H7: ``k * (rr/3600) * a * 1000`` in m3/s."""
    return f"({coef} * ({rain} / {d(RUNOFF[0])}) * {area} * {d(RUNOFF[1])})"


def drainage_excess(runoff_m3s: str = "runoff_m3s", capacity: str = "drainage_m3s") -> str:
    """H8: ``max(0, runoff - capacity)``."""
    return known(pos(f"{runoff_m3s} - {capacity}"), runoff_m3s, capacity)


def river_stage(rain: str = "rain_mm", elevation: str = "elevation_m") -> str:
    """H9: ``r2(clip(rr/25*(1+(5-e)/5), 0.2, 5))``."""
    per, low, high = STAGE
    e = d(LOW_ELEVATION_M)
    raw = f"{rain} / {d(per)} * ({d(1.0)} + ({e} - {elevation}) / {e})"
    return known(rnd(clip(raw, d(low), d(high)), 2), rain, elevation)


def flood_depth(excess: str, capacity: str, tide: str, elevation: str, floor: float) -> str:
    """``r2(clip(excess/c*0.5 + tide*0.3 + (5-e)*0.1, floor, 3))``."""
    w_excess, w_tide, w_low, high = DEPTH
    raw = (f"({excess} / {capacity}) * {d(w_excess)} + {tide} * {d(w_tide)}"
           f" + ({d(LOW_ELEVATION_M)} - {elevation}) * {d(w_low)}")
    return known(rnd(clip(raw, d(floor), d(high)), 2), excess, tide, elevation, nonzero=capacity)


def flooded_area(area: str, depth: str, floor: float) -> str:
    """``r2(clip(a*(depth/2)*0.6, floor, a))``."""
    whole, share = AREA
    return known(rnd(clip(f"{area} * ({depth} / {d(whole)}) * {d(share)}", d(floor), area), 2), area, depth)


def people_affected(population: str, area: str, flooded: str) -> str:
    """``int((pop/a) * flooded)``."""
    return known(f"CAST(({population} / {area}) * {flooded} AS BIGINT)", flooded, nonzero=area)


def lead_time(rain: str = "rain_mm", elevation: str = "elevation_m") -> str:
    """``max(1, round(12 - rr/20 - (5-e)*0.5))`` hours."""
    dry, per, low = LEAD
    hours = r0(f"{d(dry)} - {rain} / {d(per)} - ({d(LOW_ELEVATION_M)} - {elevation}) * {d(low)}")
    return known(f"greatest(1, {hours})", rain, elevation)


def index_probability(rain: str, stage: str, elevation: str, excess: str, tide: str) -> str:
    """Index probability in %, capped at 100 (unrounded)."""
    w = [d(x) for x in INDEX]
    idx = (f"{rain} * {w[0]} + {stage} * {w[1]} + ({d(INDEX_TOP_ELEVATION_M)} - {elevation}) * {w[2]}"
           f" + {excess} * {w[3]} + {tide} * {w[4]}")
    return known(f"least({d(100.0)}, ({idx}) / {d(INDEX_SCALE)} * {d(100.0)})", rain, stage, elevation, excess, tide)


def col(sql: str) -> Column:
    """A formula as a Column."""
    return F.expr(sql)


def add_hydrology(df: DataFrame, variant: Variant) -> DataFrame:
    """Add H5-H14 columns to scenario x district rows (a few projections; each
    intermediate is computed once and referenced by name)."""
    df = df.withColumns({
        "tide_m": col(tide_at(tide_base(variant))),
        "runoff_m3s": col(runoff()),
        "river_stage_m": col(river_stage()),
        "lead_time_h": col(lead_time()),
    })
    df = df.withColumn("excess_m3s", col(drainage_excess()))
    df = df.withColumn("depth_m", col(flood_depth("excess_m3s", "drainage_m3s", "tide_m",
                                                  "elevation_m", variant.depth_floor)))
    df = df.withColumn("flooded_km2", col(flooded_area("area_km2", "depth_m", variant.area_floor)))
    return df.withColumns({
        "people_affected": col(people_affected("population", "area_km2", "flooded_km2")),
        "index_prob": col(index_probability("rain_mm", "river_stage_m", "elevation_m",
                                            "excess_m3s", "tide_m")),
    })
