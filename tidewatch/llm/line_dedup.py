"""Line de-duplication over levelled sorted runs of line hashes.

Documents come in batches.  Each batch is reduced to its distinct line keys
with the number of documents that hold them and the largest of their ids.  A
run is a table of such keys, bucketed and sorted by key; runs lie in levels.  A
new batch is merged with the runs bucket by bucket, without a shuffle: keys
that no run has (anti-join) become a new run at level 0, sightings of known
keys go to a run of repeats.  A level of FANOUT runs is compacted into one run
of the next level.  So a key has one entry among all runs, and a batch adds
only its own new keys.

After the last batch, keys found in at least ``min_docs`` documents lose all
their lines but those of the largest id.  Which lines go is decided by a join
of (key, id) sightings with those keys.  The few keys that hold more than a
thousandth of all sightings (so at most a thousand) are broadcast; no other key
can fill a task.

The key of a line is the line with ASCII white space stripped at both ends and
A-Z lower-cased; keys are compared by 128-bit hashes.  A null or empty text is
one empty line; a null text stays null.  A null id counts as the smallest.
Rows that share an id are one document when keys are counted, and all of them
keep the lines of which it is the last holder.  Very long texts are handled
whole.  An empty table gives an empty result.  Input columns named n_lines or
n_dropped are replaced.
"""

from __future__ import annotations

import hashlib
import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidewatch.llm.arrays import slices
from tidewatch.llm.frames import Scratch

SPACE = " \t\n\x0b\x0c\r"
#: stands for a null id
NO_ID = -(1 << 63)
#: batches that a whole table is read in
BATCHES = 8
#: runs of a level that are compacted into one
FANOUT = 4
#: keys with more than this share of all sightings are broadcast
HOT_SHARE = 1000

_RUN = "key binary, docs long, last long"


def keys_of(lines, min_chars: int) -> tuple[np.ndarray, list[bytes]]:
    """Positions, and hashed keys, of the lines whose keys are long enough."""
    key = pc.ascii_lower(pc.ascii_trim(lines, characters=SPACE))
    at = np.flatnonzero(pc.greater_equal(pc.utf8_length(key), min_chars).to_numpy(zero_copy_only=False))
    return at, [hashlib.blake2b(x, digest_size=16).digest() for x in key.take(pa.array(at)).cast(pa.large_binary()).to_pylist()]


def _split(text) -> tuple[np.ndarray, pa.Array]:
    """Number of lines of each text, and all lines."""
    lists = pc.split_pattern(pc.fill_null(text, "").cast(pa.large_string()), "\n")
    return pc.list_value_length(lists).to_numpy(zero_copy_only=False), lists.flatten()


def _sightings(min_chars: int):
    def run(batches):
        for whole in batches:
            for a, b in slices(whole.column(1)):
                part = whole.slice(a, b - a)
                size, lines = _split(part.column(1))
                at, keys = keys_of(lines, min_chars)
                ids = np.repeat(part.column(0).to_numpy(), size)[at].tolist()
                seen = sorted(set(zip(ids, keys)))
                yield pa.RecordBatch.from_arrays([pa.array([i for i, _ in seen], pa.int64()),
                                                  pa.array([k for _, k in seen], pa.binary())], ["id", "key"])
    return run


def _cut(min_chars: int):
    """text without the lines whose keys are in ``gone``; counts of lines."""
    def run(batches):
        for whole in batches:
            for a, b in slices(whole.column("text")):
                part = whole.slice(a, b - a)
                text, gone = part.column("text"), part.column("gone")
                size, _ = _split(text)
                dropped = np.zeros(len(text), np.int64)
                hit = np.flatnonzero(pc.and_(gone.is_valid(), text.is_valid()).to_numpy(zero_copy_only=False))
                if len(hit):
                    out = text.to_pylist()
                    of, lines = _split(text.take(pa.array(hit)))
                    at, keys = keys_of(lines, min_chars)
                    first = np.concatenate(([0], np.cumsum(of)))
                    edge = np.searchsorted(at, first)
                    lines = lines.to_pylist()
                    for n, i in enumerate(hit):
                        drop = set(gone[int(i)].as_py())
                        bad = {int(at[j]) for j in range(edge[n], edge[n + 1]) if keys[j] in drop}
                        dropped[i] = len(bad)
                        out[i] = "\n".join(lines[j] for j in range(first[n], first[n + 1]) if j not in bad)
                    text = pa.array(out, text.type)
                cols = {"text": text, "n_lines": pa.array(size, pa.int64()), "n_dropped": pa.array(dropped)}
                names = [*[c for c in part.schema.names if c != "gone"], "n_lines", "n_dropped"]
                yield pa.RecordBatch.from_arrays([cols[c] if c in cols else part.column(c) for c in names], names)
    return run


class Runs:
    """Levelled runs of (key, docs, last), as bucketed tables whose files lie
    in the shared folder.  Every id must come in one batch only."""

    def __init__(self, spark: SparkSession, scratch: Scratch, fanout: int = FANOUT):
        self.spark, self.scratch, self.fanout = spark, scratch, fanout
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[list[str]] = []
        self.repeats: list[str] = []
        self.tables: dict[str, str] = {}

    def _write(self, df: DataFrame, kind: str) -> str:
        """The table's name."""
        name = f"line_{kind}_{uuid.uuid4().hex[:12]}"
        self.tables[name] = self.scratch.path(kind)
        df.write.format("parquet").bucketBy(self.buckets, "key").sortBy("key") \
            .option("path", self.tables[name]).saveAsTable(name)
        return name

    def add(self, sightings: DataFrame) -> None:
        """A batch of (key, id)."""
        batch = self._write(sightings.distinct().groupBy("key").agg(F.count(F.lit(1)).alias("docs"), F.max("id").alias("last")), "batch")
        own = self.spark.table(batch)
        runs = [self.spark.table(r) for level in self.levels for r in level]
        if not runs:
            self._enter(batch, 0)
            return
        new, known = own, None
        for run in runs:
            new = new.join(run.select("key").hint("merge"), "key", "left_anti")
            found = own.join(run.select("key").hint("merge"), "key", "left_semi")
            known = found if known is None else known.union(found)
        path = self.scratch.path("repeats")
        known.write.parquet(path)
        self.repeats.append(path)
        self._enter(self._write(new, "run"), 0)

    def _enter(self, run: str, level: int) -> None:
        if level == len(self.levels):
            self.levels.append([])
        self.levels[level].append(run)
        if len(self.levels[level]) == self.fanout:
            # keys of different runs differ, so nothing is left to add up
            merged = self._rows([self.tables[r] for r in self.levels[level]]).repartition(self.buckets, "key")
            self.levels[level] = []
            self._enter(self._write(merged, "run"), level + 1)

    def _rows(self, paths: list[str]) -> DataFrame:
        """The rows of several runs, by one scan of their files: Spark 4.1.2
        takes a union of bucketed tables for bucketed, without bringing equal
        buckets together, and so groups it wrongly."""
        return self.spark.read.schema(_RUN).parquet(*paths)

    def counts(self) -> DataFrame:
        """(key, docs, last) over all batches."""
        paths = [self.tables[r] for level in self.levels for r in level] + self.repeats
        return self._rows(paths).groupBy("key").agg(F.sum("docs").alias("docs"), F.max("last").alias("last"))

    def __enter__(self) -> Runs:
        return self

    def __exit__(self, *failure) -> None:
        for name in self.tables:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")


def _losses(sightings: DataFrame, repeated: DataFrame, total: int) -> DataFrame:
    """(id, gone): hashed keys whose lines document id loses."""
    many = F.col("docs") > total / HOT_SHARE
    hot = F.broadcast(repeated.where(many))  # at most HOT_SHARE keys
    few = repeated.where(~many)
    found = sightings.join(hot, "key").unionByName(
        sightings.join(hot.select("key"), "key", "left_anti").join(few, "key"))
    return found.where("id < last").groupBy("id").agg(F.collect_list("key").alias("gone"))


def drop_lines(docs: DataFrame, min_chars: int = 40, min_docs: int = 5, batches: int = BATCHES,
               doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """docs with the repeated lines gone from ``text``; adds n_lines (before
    dropping) and n_dropped."""
    spark = docs.sparkSession
    columns = [c for c in docs.columns if c not in ("n_lines", "n_dropped")]
    ident = F.coalesce(F.col(doc_id).cast("long"), F.lit(NO_ID)).alias("id")
    body = F.col(text).cast("string").alias("text")
    scratch = Scratch(spark)
    seen = docs.select(ident, body).mapInArrow(_sightings(min_chars), "id long, key binary") \
        .withColumn("batch", F.pmod(F.xxhash64("id"), F.lit(batches)).cast("int"))
    with scratch, Runs(spark, scratch) as runs:
        # the result reads these two, so they outlive the runs
        seen = Scratch(spark).stored(seen, "sightings", by="batch")
        for b in range(batches):
            runs.add(seen.where(F.col("batch") == b).select("key", "id"))
        repeated = Scratch(spark).stored(runs.counts().where(F.col("docs") >= min_docs), "repeated")
    gone = _losses(seen.select("key", "id"), repeated, seen.count())
    rest = F.struct(F.col(doc_id).alias("__id"), *[F.col(f"`{c}`") for c in columns if c not in (doc_id, text)]).alias("rest")
    told = docs.select(ident, body, rest).join(gone, "id", "left").select("text", "rest", "gone")
    kind = told.select("text", "rest").schema.add("n_lines", "long").add("n_dropped", "long")
    own = {doc_id: "rest.__id", text: "text"}
    return told.mapInArrow(_cut(min_chars), kind).select(
        *[F.col(own.get(c, f"rest.`{c}`")).alias(c) for c in columns], "n_lines", "n_dropped")
