"""Explicit schemas.  Inference costs a pass over the data and
drifts between long and double, so every reader passes one of these."""

from __future__ import annotations

from pyspark.sql import types as T

# Flat weather event, as published on the weather topic.
WEATHER_EVENT = T.StructType([
    T.StructField("timestamp", T.StringType()),          # local yyyy-MM-ddTHH:mm
    T.StructField("suhu_c", T.DoubleType()),             # temperature C
    T.StructField("kelembaban_pct", T.LongType()),       # humidity %
    T.StructField("curah_hujan_mm", T.DoubleType()),     # rain mm
    T.StructField("kecepatan_angin_ms", T.DoubleType()),  # wind m/s
    T.StructField("lokasi", T.StringType()),
])

# Raw weather API response (the part the normaliser reads) plus HTTP status.
RAW_WEATHER_CURRENT = T.StructType([
    T.StructField("time", T.StringType()),
    T.StructField("temperature_2m", T.DoubleType()),
    T.StructField("relative_humidity_2m", T.LongType()),
    T.StructField("precipitation", T.DoubleType()),
    T.StructField("wind_speed_10m", T.DoubleType()),     # km/h
])
RAW_WEATHER = T.StructType([T.StructField("current", RAW_WEATHER_CURRENT)])

# Flat report event, as published on the report topic.
REPORT_EVENT = T.StructType([
    T.StructField("timestamp", T.StringType()),
    T.StructField("judul", T.StringType()),
    T.StructField("link", T.StringType()),
    T.StructField("sumber", T.StringType()),
])

# Nested report document (disaster-map style).
REPORT_TAGS = T.StructType([
    T.StructField("flood_depth", T.LongType()),
    T.StructField("kecamatan", T.StringType()),
])
REPORT_PROPERTIES = T.StructType([
    T.StructField("pkey", T.StringType()),
    T.StructField("created_at", T.StringType()),
    T.StructField("source", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("tags", REPORT_TAGS),
    T.StructField("text", T.StringType()),
])
REPORT_GEOMETRY = T.StructType([
    T.StructField("properties", REPORT_PROPERTIES),
    T.StructField("geometry", T.StructType([
        T.StructField("coordinates", T.ArrayType(T.DoubleType())),
    ])),
])
REPORT_DOCUMENT = T.StructType([
    T.StructField("result", T.StructType([
        T.StructField("objects", T.StructType([
            T.StructField("output", T.StructType([
                T.StructField("geometries", T.ArrayType(REPORT_GEOMETRY)),
            ])),
        ])),
    ])),
])

# Batch result row and the nested result document that wraps it.
BATCH_RESULT = T.StructType([
    T.StructField("Kecamatan", T.StringType()),
    T.StructField("Status", T.StringType()),
    T.StructField("Probabilitas", T.DoubleType()),
    T.StructField("Tinggi_Genangan_m", T.DoubleType()),
    T.StructField("Penduduk_Terdampak", T.LongType()),
    T.StructField("Lead_Time_jam", T.IntegerType()),
])
RESULT_DOCUMENT = T.StructType([
    T.StructField("timestamp_analisis", T.StringType()),
    T.StructField("cuaca_referensi", T.StructType([
        T.StructField("waktu", T.StringType()),
        T.StructField("curah_hujan", T.DoubleType()),
        T.StructField("suhu", T.DoubleType()),
        T.StructField("angin", T.DoubleType()),
    ])),
    T.StructField("prediksi_kecamatan", T.ArrayType(BATCH_RESULT)),
])

# Internal scenario row: one weather state to be scored against every district.
SCENARIO_COLUMNS = ["scenario_id", "location", "observed_text", "rain_mm",
                    "humidity_pct", "temp_c", "wind_ms", "month",
                    "rain_3day_mm", "sunshine_h"]
