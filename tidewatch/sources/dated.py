"""Event archive by dataset and day, compacted under a commit manifest
(SURVEY S10, T5, O1).

``path/segment=<s>/dataset=<d>/day=<yyyy-mm-dd>/`` is a *unit*: the rows of one
dataset and day that one micro-batch or one compaction wrote.  ``path/_log/<n>``
is a manifest: the units that count after commit n.  Readers follow the highest
manifest, so a batch or a compaction appears as a whole or not at all; folders
of a writer that died are in no manifest and are never read.  A commit is one
file that appears by a rename; a writer that finds its number taken starts from
the new manifest again.

Manifests hold folder names only, never rows.  Their length is that of the
calendar times the datasets, plus the batches since the last compaction.
"""

from __future__ import annotations

import json
import uuid
from collections import defaultdict
from collections.abc import Callable
from math import ceil

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.sources import publish as PB
from tidewatch.sources import versions as V

LOG = "_log"
#: manifests that stay, for readers that follow an older one
KEEP = 10
#: bytes of a compacted file, about
FILE_BYTES = 128 << 20
#: day of rows without an event time
NO_DAY = "none"


def manifest(spark: SparkSession, path: str) -> tuple[int, dict]:
    """Number and content of the newest manifest (-1 and an empty one at first):
    ``units`` that count, the last ``batch`` appended, and ``gone``, replaced
    units with the commit that replaced them."""
    done = [int(n) for n in V.names(spark, f"{path}/{LOG}") if n.isdigit()]
    if not done:
        return -1, {"batch": -1, "units": [], "gone": {}}
    return max(done), json.loads(V.get_text(spark, f"{path}/{LOG}/{max(done)}"))


def _commit(spark: SparkSession, path: str, change: Callable[[dict, int], dict | None]) -> bool:
    """Publish ``change(manifest, number)``; None: there is nothing to publish any more."""
    while True:
        n, old = manifest(spark, path)
        new = change(old, n + 1)
        if new is None:
            return False
        if V.put_text(spark, f"{path}/{LOG}/{n + 1}", json.dumps(new)):
            for name in V.names(spark, f"{path}/{LOG}"):
                if name.isdigit() and int(name) <= n + 1 - KEEP:
                    V.remove(spark, f"{path}/{LOG}/{name}")
            return True


def _units(spark: SparkSession, path: str, segment: str) -> list[str]:
    """Units of a segment that was written."""
    return [f"{segment}/{d}/{day}" for d in V.names(spark, f"{path}/{segment}") if d.startswith("dataset=")
            for day in V.names(spark, f"{path}/{segment}/{d}") if day.startswith("day=")]


def _place(unit: str) -> tuple[str, str]:
    """(dataset, day) of a unit."""
    _, dataset, day = unit.split("/")
    return dataset.removeprefix("dataset="), day.removeprefix("day=")


def append(batch: DataFrame, path: str, batch_id: int, time_col: str = "ts") -> None:
    """Archive one micro-batch of topic records.  A replayed batch changes
    nothing: it is left out once committed, and overwrites its own folder before
    that.  Rows without a time are kept, under a day of their own."""
    spark = batch.sparkSession
    if batch_id <= manifest(spark, path)[1]["batch"]:
        return
    segment = f"segment=b{batch_id}"
    day = F.coalesce(F.date_format(time_col, "yyyy-MM-dd"), F.lit(NO_DAY))
    PB.with_dataset(batch).withColumn("day", day).write.mode("overwrite") \
        .partitionBy("dataset", "day").parquet(f"{path}/{segment}")
    new = _units(spark, path, segment)
    _commit(spark, path, lambda old, n: None if batch_id <= old["batch"] else
            old | {"batch": batch_id, "units": old["units"] + new})


def archive_stream(records: DataFrame, path: str, checkpoint: str, *, time_col: str = "ts",
                   trigger: dict | None = None):
    """S10 + T3 + T5: every record of a stream once, by dataset and day."""
    return (records.writeStream.foreachBatch(lambda batch, i: append(batch, path, i, time_col))
            .option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"availableNow": True})).start())


def _read_units(spark: SparkSession, path: str, schema: T.StructType, units: list[str]) -> DataFrame:
    whole = T.StructType([f for f in schema.fields if f.name not in ("segment", "dataset", "day")]
                         + [T.StructField(c, T.StringType()) for c in ("segment", "dataset", "day")])
    if not units:
        return spark.createDataFrame([], whole).drop("segment")
    return spark.read.schema(whole).option("basePath", path).parquet(*[f"{path}/{u}" for u in units]).drop("segment")


def read(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """All archived records with dataset and day; filters on these two prune
    folders.  schema: the columns of the records.  An absent archive has no rows."""
    return _read_units(spark, path, schema, manifest(spark, path)[1]["units"])


def newest_day(spark: SparkSession, path: str, schema: T.StructType, dataset: str) -> DataFrame:
    """O1's input: the records of the newest day of a dataset.  The day comes
    from the manifest, so no file of an older day is listed or opened; rows
    without a time are no day.  No rows where the dataset has none."""
    units = manifest(spark, path)[1]["units"]
    days = [day for d, day in map(_place, units) if d == dataset and day != NO_DAY]
    day = max(days, default=NO_DAY)
    rows = _read_units(spark, path, schema, [u for u in units if _place(u) == (dataset, day) and days])
    return rows.where((F.col("dataset") == dataset) & (F.col("day") == day))


def latest(spark: SparkSession, path: str, schema: T.StructType, dataset: str, time_col: str = "ts") -> DataFrame:
    """O1: the newest record of a dataset (one row or none)."""
    return newest_day(spark, path, schema, dataset).orderBy(F.desc(time_col)).limit(1)


def compact(spark: SparkSession, path: str, schema: T.StructType, time_col: str = "ts",
            min_units: int = 2, file_bytes: int = FILE_BYTES) -> int:
    """Rewrite the days that lie in at least ``min_units`` units as one unit each,
    in files of about ``file_bytes``; returns the units replaced.

    Rows are range-partitioned by dataset, day and time: small days share a task,
    a day with most of the rows is cut over many.  The new units replace the old
    ones by one commit, and only if all of these still count, so of two
    compactions of one day the second changes nothing; batches appended
    meanwhile stay."""
    by_place = defaultdict(list)
    for u in manifest(spark, path)[1]["units"]:
        by_place[_place(u)].append(u)
    old = [u for us in by_place.values() if len(us) >= min_units for u in us]
    if not old:
        return 0
    at, fs = V._file(spark, path)
    size = sum(fs.getContentSummary(V._file(spark, f"{path}/{u}")[0]).getLength() for u in old)
    segment = f"segment=c{uuid.uuid4().hex}"
    rows = _read_units(spark, path, schema, old)
    order = ["dataset", "day", time_col]
    spread = F.xxhash64(*[c for c in rows.columns if c not in order])  # a time that most rows share is cut, too
    rows.repartitionByRange(max(1, ceil(size / file_bytes)), *order, spread).sortWithinPartitions(*order) \
        .write.mode("overwrite").partitionBy("dataset", "day").parquet(f"{path}/{segment}")
    new = _units(spark, path, segment)

    def swap(now: dict, n: int) -> dict | None:
        if not set(old) <= set(now["units"]):
            return None
        return now | {"units": [u for u in now["units"] if u not in set(old)] + new,
                      "gone": now["gone"] | {u: n for u in old}}

    return len(old) if _commit(spark, path, swap) else 0


def vacuum(spark: SparkSession, path: str, keep: int = KEEP) -> int:
    """Remove the units that were replaced at least ``keep`` commits ago;
    returns their number.  Folders that no manifest ever held stay: they may
    belong to a writer at work."""
    n, now = manifest(spark, path)
    old = [u for u, at in now["gone"].items() if at <= n - keep]
    for u in old:
        V.remove(spark, f"{path}/{u}")
    if old:
        _commit(spark, path, lambda m, _: m | {"gone": {u: at for u, at in m["gone"].items() if u not in set(old)}})
    return len(old)
