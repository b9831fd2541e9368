"""Centroid clustering on bit planes.

A vector of 64 components becomes integers floor(1024 * x), written in two's
complement; bit b of all 64 components is one 64-bit word, a plane.  The inner
product of two vectors is the sum over their planes a and b of
weight(a) * weight(b) * popcount(plane_a AND plane_b), where a plane weighs
2^bit and the sign plane the negative of that.  It is exact, and so are the
squared distances |x|^2 - 2 x.c + |c|^2.

The planes are packed once into a table in the shared folder.  A round sends
the centroids (k times 64 integers) to the tasks; each task assigns its vectors
and returns its sums by cluster and component, counted plane by plane, so what
the driver gets a round has a fixed size.

Vectors take part that have exactly 64 components, none of them null, NaN or
infinite; others (null vectors too) are left out of the result.  Components
beyond 2^17 count as 2^17, so that every squared distance fits a long; a sum of
distances beyond a long is given as the largest long.  Equal distances go to
the smaller cluster.  Repeated rows are vectors of their own.  A null id takes
part but is never a first centroid.  With fewer vectors than k there are fewer
centroids; an empty table gives an empty result.  Other columns are ignored,
whatever their names.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidewatch.llm.frames import stored

WIDTH = 64
SCALE = 1024
#: largest integer component: 64 * (2 * 2^27)^2 fits a long
LIMIT = 1 << 27
#: first centroids: smallest sha256 of "<SEED>:<id>"
SEED = "3"

_SUMS = "cluster int, item int, total long"
#: items of _SUMS beside the components 0 to 63
COUNT, DISTANCE = -1, -2


def planes_of(values: np.ndarray, planes: int) -> np.ndarray:
    """(planes, n) words of n rows of 64 integers that fit so many bits."""
    bits = ((values[None] >> np.arange(planes)[:, None, None]) & 1).astype(np.uint8)
    return np.packbits(bits, axis=2, bitorder="little").view("<u8")[:, :, 0]


def weights(planes: int) -> list[int]:
    return [1 << b for b in range(planes - 1)] + [-(1 << (planes - 1))]


def values_of(words: np.ndarray) -> np.ndarray:
    """The n rows of 64 integers of (planes, n) words."""
    out = np.zeros((words.shape[1], WIDTH), np.int64)
    for word, w in zip(words, weights(len(words))):
        out += _bits(word).astype(np.int64) * w
    return out


def _bits(word: np.ndarray) -> np.ndarray:
    return np.unpackbits(np.ascontiguousarray(word, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def dots(words: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Inner products of n vectors, (planes, n), with one, (planes,), or with
    n others, (planes, n)."""
    total = np.zeros(words.shape[1], np.int64)
    for a, wa in zip(words, weights(len(words))):
        part = np.zeros(words.shape[1], np.int64)
        for b, wb in zip(other, weights(len(other))):
            if b.ndim or b:
                part += np.bitwise_count(a & b).astype(np.int64) * wb
        total += part * wa
    return total


class Centroids:
    """k centroids, as integers and as planes."""

    def __init__(self, values: list[list[int]]):
        self.values = values
        v = np.array(values, np.int64).reshape(-1, WIDTH)
        self.words = planes_of(v, planes_for(int(v.min()), int(v.max())))
        self.norm = (v * v).sum(axis=1)

    def assign(self, words: np.ndarray, norm: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Nearest centroid of each vector and its squared distance."""
        cluster, best = np.zeros(len(norm), np.int32), None
        for c in range(len(self.values)):
            far = norm + self.norm[c] - 2 * dots(words, self.words[:, c])
            if best is None:
                best = far
            else:
                nearer = far < best
                cluster[nearer], best[nearer] = c, far[nearer]
        return cluster, best

    def moved(self, sums: dict) -> Centroids:
        """Floors of the clusters' means; empty clusters stay."""
        return Centroids([[sums[c, j] // n for j in range(WIDTH)] if (n := sums.get((c, COUNT), 0)) else own
                          for c, own in enumerate(self.values)])

    def digest(self, c: int) -> str:
        return hashlib.sha256(",".join(map(str, self.values[c])).encode()).hexdigest()


def planes_for(low: int, high: int) -> int:
    """Bits of two's complement that hold low to high."""
    return max(high.bit_length(), (~low).bit_length() if low < 0 else 0) + 1


def _pack(planes: int):
    def run(batches):
        for b in batches:
            v = np.asarray(b.column(1).flatten(), np.float64).reshape(-1, WIDTH)
            v = np.clip(np.floor(v * SCALE), -LIMIT, LIMIT).astype(np.int64)
            words = planes_of(v, planes)
            at = np.arange(len(v) + 1, dtype=np.int32) * (8 * planes)
            body = pa.Array.from_buffers(pa.binary(), len(v), [None, pa.py_buffer(at), pa.py_buffer(words.T.tobytes())])
            yield pa.RecordBatch.from_arrays([b.column(0), body, pa.array(dots(words, words))], ["id", "planes", "norm"])
    return run


def _words(column, planes: int) -> np.ndarray:
    """(planes, n) words of a binary Arrow column."""
    body = column.cast(pa.binary())
    at = np.frombuffer(body.buffers()[1], np.int32, 1, body.offset * 4)[0]
    raw = np.frombuffer(body.buffers()[2], "<u8", planes * len(body), at)
    return np.ascontiguousarray(raw.reshape(-1, planes).T)


def _sums(centroids: Centroids, planes: int):
    """Counts, distances and component sums by cluster of a partition."""
    def run(batches):
        k = len(centroids.values)
        total = np.zeros((k, WIDTH), np.int64)
        count, inertia = np.zeros(k, np.int64), [0] * k
        for b in batches:
            if not b.num_rows:
                continue
            words = _words(b.column(1), planes)
            cluster, far = centroids.assign(words, b.column(2).to_numpy())
            member = (cluster[None] == np.arange(k)[:, None])
            count += member.sum(axis=1)
            for c in range(k):
                inertia[c] += sum(far[member[c]].tolist())
            one = member.astype(np.float32)
            for word, w in zip(words, weights(planes)):
                total += (one @ _bits(word).astype(np.float32)).astype(np.int64) * w
        rows = [(c, j, int(total[c, j])) for c in range(k) if count[c] for j in range(WIDTH)]
        rows += [(c, COUNT, int(count[c])) for c in range(k) if count[c]]
        rows += [(c, DISTANCE, min(inertia[c], 2**63 - 1)) for c in range(k) if count[c]]
        c, j, x = zip(*rows) if rows else ((), (), ())
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int32()), pa.array(j, pa.int32()), pa.array(x, pa.int64())],
                                         ["cluster", "item", "total"])
    return run


def _gather(packed: DataFrame, centroids: Centroids, planes: int) -> dict:
    """{(cluster, item): total}: at most k * 66 rows."""
    found = packed.mapInArrow(_sums(centroids, planes), _SUMS).groupBy("cluster", "item") \
        .agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"))
    return {(r.cluster, r.item): int(r.total) for r in found.collect()}


def _assigned(centroids: Centroids, planes: int):
    def run(batches):
        for b in batches:
            cluster, far = centroids.assign(_words(b.column(1), planes), b.column(2).to_numpy()) if b.num_rows else ([], [])
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(cluster, pa.int32()), pa.array(far, pa.int64())],
                                             ["id", "cluster", "distance"])
    return run


def cluster(vectors: DataFrame, k: int = 8, rounds: int = 10, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256)
    of every vector that takes part, after ``rounds`` rounds."""
    v = F.col(vector).cast("array<double>")
    fits = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    kept = vectors.select(F.col(vec_id).cast("long").alias("id"), v.alias("v")).where((F.size("v") == WIDTH) & fits)
    low, high = kept.agg(F.min(F.array_min("v")), F.max(F.array_max("v"))).first()
    schema = f"{vec_id} long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
    if low is None:
        return vectors.sparkSession.createDataFrame([], schema)
    bound = [int(min(max(np.floor(x * SCALE), -LIMIT), LIMIT)) for x in (low, high)]
    planes = planes_for(*bound)
    packed = stored(kept.mapInArrow(_pack(planes), "id long, planes binary, norm long"), "planes")
    first = packed.where("id is not null").orderBy(F.sha2(F.concat(F.lit(f"{SEED}:"), F.col("id").cast("string")), 256), "planes") \
        .limit(k).select("planes").collect()
    if not first:  # only null ids: nothing to start from
        first = packed.orderBy("planes").limit(k).select("planes").collect()
    start = np.array([np.frombuffer(r.planes, "<u8") for r in first]).T
    centroids = Centroids(values_of(start).tolist())
    for _ in range(rounds):
        centroids = centroids.moved(_gather(packed, centroids, planes))
    sums = _gather(packed, centroids, planes)
    own = [sums.get((c, DISTANCE), 0) for c in range(len(first))]
    most = 2**63 - 1

    def by_cluster(values, kind):
        return F.element_at(F.array(*[F.lit(x).cast(kind) for x in values]), F.col("cluster") + 1)

    return packed.mapInArrow(_assigned(centroids, planes), "id long, cluster int, distance long").select(
        F.col("id").alias(vec_id), "cluster", "distance",
        by_cluster([min(x, most) for x in own], "long").alias("cluster_inertia"),
        F.lit(min(sum(own), most)).cast("long").alias("inertia"),
        by_cluster([centroids.digest(c) for c in range(len(own))], "string").alias("centroid_sha256"))
