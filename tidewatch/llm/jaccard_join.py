"""Exact n-gram Jaccard join in a metric space, down to link components.

A document is its set of distinct k-word shingles; Jaccard distance is a
metric.  Two documents link when ``den * |A n B| >= num * |A u B|``.

1. *Projections.*  Unrelated texts lie at distance 1 from each other and from
   every pivot, so windows of twice the link distance around Voronoi borders
   would copy every document into every region.  The space is therefore first
   projected: for documents of like size, shingles are dealt by hash into
   more classes than two linked sets can differ in shingles, so a linked pair
   lies at distance zero in at least one non-empty class.  Documents that
   coincide in a class belong to one candidate *family* (components of star
   links to the smallest id, never all pairs).
2. *Regions.*  Inside a family, pivots create Voronoi regions; a document is
   copied into each region whose pivot is no more than twice the link distance
   farther than its nearest pivot (triangle inequality), and regions are
   joined recursively and exactly (`region_links`).
3. *Large families* are never gathered: their documents stay dealt over tasks
   of bounded size, blocks of pivots are sent to them, and each round compares
   the pivots with the whole family.  A round resolves its pivots; documents
   outside a family's largest component become the next pivots, in growing
   blocks, until none is left.  Documents within the link distance of a pivot
   share its component, so copies of a text need one round.

Exact copies of a set are collapsed to the smallest id beforehand.  There is
no cap on partners or candidates.
"""

from __future__ import annotations

from functools import lru_cache
from math import ceil, exp

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidewatch.llm import arrays as A
from tidewatch.llm.components import connected_components, roots
from tidewatch.llm.frames import Scratch, stored, text_size
from tidewatch.llm.repeats import _arrow, _cut, _table

#: largest family joined as a whole inside one task
FAMILY = 200
#: regions of at most so many documents are compared document by document
LEAF = 12
#: pivots of a region, and of a large family in its first round
PIVOTS = 4
FIRST_BLOCK, GROWTH, LARGEST_BLOCK = 32, 4, 2048
#: shingles that count as common, and in how many documents of a task
COMMON, COMMON_HERE = 300_000, 4
#: pivots that travel together
PACK = 128
#: signatures that a task collects before it sorts and sends them
FLUSH = 600_000
#: signatures of a hash shard
SHARD = 4_000_000
#: signatures of a shard that are grouped at once
RANGE = 100_000
#: classes of copies with more than this share of all rows are broadcast
HOT_SHARE = 1000
#: rows of a table small enough to broadcast (two longs a row)
BROADCAST_ROWS = 500_000


# ------------------------------------------------------------- projections
@lru_cache(maxsize=None)
def bands(num: int, den: int, largest: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Size bands: lowest size, differing shingles allowed, classes.

    Band b holds sizes low[b] .. low[b+1]-1; a document links only with its
    own and the neighbouring bands.  A pair whose smaller set is in band b
    differs in at most tau[b] shingles.  There are classes[b] > tau[b]
    classes, chosen so that hardly any set leaves classes[b] - tau[b] of them
    empty (such sets send their empty classes too).
    """
    low = [1]
    while low[-1] <= largest:
        low.append(den * low[-1] // num + 1)
    low.append(den * low[-1] // num + 1)
    tau, classes = [], []
    for a, b in zip(low, low[1:]):
        union = den * (b - 1) // num
        t = union - -(-num * union // den)
        best = (2.0, 1)
        for g in range(1, t + 60):
            mean = (t + g) * exp(-a / (t + g)) if t + g > 1 else 0.0
            tail, term = 0.0, exp(-mean)
            for i in range(1, g + 40):
                term *= mean / i
                tail += term if i >= g else 0.0
            best = min(best, (tail, g))
            if tail < 1e-8:
                break
        tau.append(t)
        classes.append(t + best[1])
    return np.array(low[:-1]), np.array(tau), np.array(classes)


def _holds(listed: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Whether each hash is in the sorted list.  The upper bits tell that most
    are not; only the others are looked up."""
    bits = max(len(listed), 1).bit_length() + 4
    some = np.zeros(1 << bits, bool)
    some[listed >> np.uint64(64 - bits)] = True
    out = some[v >> np.uint64(64 - bits)]
    maybe = np.flatnonzero(out)
    if len(maybe):
        own = v[maybe]
        out[maybe] = listed[np.minimum(np.searchsorted(listed, own), len(listed) - 1)] == own
    return out


class Shingles:
    """Distinct shingle hashes of each text of a block."""

    def __init__(self, column, k: int):
        w = A.Words(*A.utf8(column), lower=True)
        h = w.hashes(11)
        doc = w.text
        full = np.flatnonzero(w.has_window(k))
        values = [A.windows(h, k, 20)[full]] if len(full) else []
        owner = [doc[full]]
        for n in range(1, k):               # the whole text, where it has n < k words
            short = np.flatnonzero(w.count == n)
            if len(short):
                first = w.first[short]
                acc = sum(h[first + j] * m for j, m in enumerate(A.multipliers(n, 20 + n)))
                values.append(A.mix(acc))
                owner.append(short)
        v = np.concatenate(values) if values else np.zeros(0, np.uint64)
        o = np.concatenate(owner)
        # by value, then by text: two plain sorts cost a third of a lexsort
        order = np.argsort(v)
        own = o[order]
        order = order[np.argsort(own.astype(np.uint16) if len(w.count) <= 1 << 16 else own, kind="stable")]
        v, o = v[order], o[order]
        new = np.ones(len(v), bool)
        new[1:] = (v[1:] != v[:-1]) | (o[1:] != o[:-1])
        self.value, self.doc = v[new], o[new]
        self.size = np.bincount(self.doc, minlength=len(w.count))
        self.first = np.concatenate(([0], np.cumsum(self.size)))

    def set(self, i: int) -> np.ndarray:
        return self.value[self.first[i]:self.first[i + 1]]

    def fingerprints(self) -> tuple[np.ndarray, np.ndarray]:
        out = []
        for salt in (0x1F, 0x2F):
            sums = np.zeros(len(self.size), np.uint64)
            np.add.at(sums, self.doc, A.mix(self.value ^ np.uint64(salt)))
            out.append(sums)
        return out[0], out[1]

    def signatures(self, num: int, den: int, common: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(signature, text): one for each class a set has in the schemes of
        its own band and of the band below.

        A class is weak when it is empty or holds common shingles only.  Of
        at least classes - tau equal ones, a linked pair has a strong one if
        either set has fewer weak classes than that; only sets with as many
        send their weak classes too.  No link is lost, whatever counts as
        common, and texts that merely share a passage do not meet."""
        # rounded up, so that blocks share their bands
        low, tau, classes = bands(num, den, 2 << int(self.size.max(initial=1)).bit_length())
        own = np.searchsorted(low, self.size, side="right") - 1
        uncommon = ~_holds(common, self.value)
        sigs, docs = [], []
        for back in (0, 1):
            band = own - back
            use = (band >= 0) & (self.size > 0)
            count = np.where(use, classes[np.maximum(band, 0)], 0)
            base = np.concatenate(([0], np.cumsum(count)))
            sel = use[self.doc]
            d, v = self.doc[sel], self.value[sel]
            b = band[d].astype(np.uint64)
            cls = A.mix(v + b * np.uint64(0x9E3779B97F4A7C15)) % count[d].astype(np.uint64)
            sums = np.zeros(base[-1], np.uint64)
            np.add.at(sums, base[d] + cls.astype(np.int64), A.mix(v ^ np.uint64(0x5DEECE66D)))
            rare = uncommon[sel]
            strong = np.zeros(base[-1], bool)
            strong[(base[d] + cls.astype(np.int64))[rare]] = True
            owner = np.repeat(np.arange(len(count)), count)
            place = np.arange(base[-1]) - base[owner]
            band_of = band[owner]
            weak = np.bincount(owner[~strong], minlength=len(count))
            send = strong | (weak >= count - tau[np.maximum(band, 0)])[owner]
            tag = (band_of.astype(np.uint64) << np.uint64(40)) + place.astype(np.uint64)
            sigs.append(A.mix(sums + A.mix(tag + np.uint64(7)))[send])
            docs.append(owner[send])
        return np.concatenate(sigs), np.concatenate(docs)


# ------------------------------------------------------------------ regions
class Region:
    """Sets of one region over a common universe of element numbers."""

    def __init__(self, sets: list[np.ndarray], num: int, den: int):
        self.size = np.array([len(s) for s in sets], np.int64)
        every = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
        self.universe, self.code = np.unique(every, return_inverse=True)
        self.first = np.concatenate(([0], np.cumsum(self.size)))[:-1]
        self.num, self.den = num, den

    def common(self, codes: np.ndarray) -> np.ndarray:
        """Shingles that each set shares with the set of these element numbers."""
        flag = np.zeros(len(self.universe), np.int64)
        flag[codes] = 1
        return np.add.reduceat(flag[self.code], self.first)

    def own(self, i: int) -> np.ndarray:
        return self.code[self.first[i]:self.first[i] + self.size[i]]

    def against(self, inter: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Distance to a set of that size, and whether it links."""
        union = self.size + size - inter
        return 1.0 - inter / union, self.den * inter >= self.num * union


def region_links(sets: list[np.ndarray], num: int, den: int) -> list[tuple[int, int]]:
    """All linked pairs (i < j) of the sets, by recursive Voronoi regions."""
    if len(sets) < 2:
        return []
    region = Region(sets, num, den)
    rows: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def row(i: int):
        if i not in rows:
            rows[i] = region.against(region.common(region.own(i)), int(region.size[i]))
        return rows[i]

    width = 2 * (1 - num / den) + 1e-9
    found: set[tuple[int, int]] = set()
    todo = [np.arange(len(sets))]
    while todo:
        part = todo.pop()
        cells = []
        if len(part) > LEAF:
            pivots = [int(part[0])]
            while len(pivots) < PIVOTS:     # the farthest from the pivots so far
                far = np.min([row(p)[0][part] for p in pivots], axis=0)
                pivots.append(int(part[np.argmax(far)]))
            dist = np.array([row(p)[0][part] for p in pivots])
            home, near = np.argmin(dist, axis=0), dist.min(axis=0)
            cells = [part[dist[j] <= near + width] for j in range(PIVOTS) if (home == j).any()]
        if cells and max(map(len, cells)) < len(part) and sum(map(len, cells)) < 3 * len(part):
            todo += cells
            continue
        for at, i in enumerate(part):       # a leaf, or a region that pivots can't part
            later = part[at + 1:]
            if len(later):
                for j in later[row(int(i))[1][later]]:
                    found.add((int(i), int(j)))
    return sorted(found)


# ----------------------------------------------------------------- the join
def common_shingles(base: DataFrame, k: int) -> np.ndarray:
    """Hashes of at most COMMON shingles that several documents of a task
    hold, those of most documents first.  Tasks count whole partitions and
    send what occurs in COMMON_HERE documents of theirs or more; the sums are
    added up by Spark.  (Which shingles are listed affects the work, not the
    links.)"""
    ddl = "s long, n long"
    schema = _arrow(ddl)

    def count(batches):
        keys, n = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        for batch in batches:
            for a, b in A.slices(batch.column("text")):
                u, c = np.unique(Shingles(batch.column("text").slice(a, b - a), k).value, return_counts=True)
                c = c[(many := c > 1)]
                every, more = np.concatenate([keys, u[many]]), np.concatenate([n, c])
                order, new = A.groups(every)
                keys = every[order][new]
                n = np.add.reduceat(more[order], np.flatnonzero(new)) if len(every) else more
        use = n >= COMMON_HERE
        yield pa.RecordBatch.from_arrays([pa.array(keys[use].view(np.int64)), pa.array(n[use])], schema=schema)

    top = base.select("text").mapInArrow(count, ddl).groupBy("s").agg(F.sum("n").alias("n")) \
        .orderBy(F.desc("n"), "s").limit(COMMON).select("s").toArrow()
    return np.sort(top.column("s").to_numpy().view(np.uint64))


def _collect(k: int, num: int, den: int, shards: int, common):
    """Task body of the first pass: one row a document, packed signatures by
    shard, and star links of documents whose signatures meet in the task."""
    ddl = ("kind int, id long, n long, fp0 long, fp1 long, "
           "shard int, size int, sigs binary, ids binary")
    schema = _arrow(ddl)
    none = {"id": None, "n": None, "fp0": None, "fp1": None, "shard": None,
            "size": None, "sigs": None, "ids": None}

    def flush(sigs, ids):
        s, d = np.concatenate(sigs), np.concatenate(ids)
        order = np.argsort(s)
        s, d = s[order], d[order]
        new = np.diff(s, prepend=~s[:1]) != 0
        first = np.minimum.reduceat(d, np.flatnonzero(new))
        lead = first[np.cumsum(new) - 1]
        node, root = roots(d[d != lead], lead[d != lead])
        out = []
        if len(node):
            out.append(none | {"kind": 2, "size": len(node), "sigs": A.pack(node), "ids": A.pack(root)})
        s = s[new]
        for shard, a, b in _cut(s, shards):
            out.append(none | {"kind": 1, "shard": shard, "size": b - a,
                               "sigs": A.pack_sorted(s[a:b]), "ids": A.pack(first[a:b])})
        return pa.RecordBatch.from_pylist(out, schema=schema)

    def judge(batch, sigs, ids):
        sh = Shingles(batch.column("text"), k)
        known = batch.column("id").is_valid().to_numpy(zero_copy_only=False)
        ident = batch.column("id").fill_null(0).to_numpy()
        f0, f1 = sh.fingerprints()
        rows = len(ident)
        # copies of a set inside the block send its signatures once
        ok = np.flatnonzero(known)
        order, lead = A.groups(f0[ok], f1[ok], ident[ok].view(np.uint64) ^ np.uint64(2**63))
        g0, g1 = f0[ok][order], f1[ok][order]
        lead[1:] = (g0[1:] != g0[:-1]) | (g1[1:] != g1[:-1])
        sends = np.zeros(rows, bool)
        sends[ok[order[lead]]] = True
        s, d = sh.signatures(num, den, common.value)
        use = sends[d]
        if use.any():
            sigs.append(s[use])
            ids.append(ident[d[use]])
        gap = lambda t: pa.nulls(rows, t)
        return pa.RecordBatch.from_arrays(
            [pa.array(np.zeros(rows, np.int32)), batch.column("id"), pa.array(sh.size.astype(np.int64)),
             pa.array(f0.view(np.int64)), pa.array(f1.view(np.int64)),
             gap(pa.int32()), gap(pa.int32()), gap(pa.binary()), gap(pa.binary())], schema=schema)

    def task(batches):
        sigs, ids = [], []
        for batch in batches:
            for a, b in A.slices(batch.column("text")):
                yield judge(batch.slice(a, b - a), sigs, ids)
                if sum(map(len, sigs)) >= FLUSH:
                    yield flush(sigs, ids)
                    sigs, ids = [], []
        if sigs:
            yield flush(sigs, ids)

    return task, ddl


def _stars(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """(id, smallest id linked through this shard's signatures).  The packed
    rows are sorted, so that the shard is grouped range by range of its
    signatures, and only these are ever copied and sorted."""
    held = [(A.unpack_sorted(s.as_py(), n.as_py(), np.uint64), A.unpack(d.as_py(), n.as_py(), np.int64))
            for n, s, d in zip(table.column("size"), table.column("sigs"), table.column("ids"))]
    total = sum(len(s) for s, _ in held)
    least, most = min(int(s[0]) for s, _ in held), max(int(s[-1]) for s, _ in held)
    ranges = max(1, ceil(total / RANGE))
    bounds = np.array([least + (most - least) * i // ranges for i in range(1, ranges)], np.uint64)
    cuts = [np.concatenate(([0], np.searchsorted(s, bounds), [len(s)])) for s, _ in held]
    node, root = np.zeros(0, np.int64), np.zeros(0, np.int64)
    for i in range(ranges):
        s = np.concatenate([x[c[i]:c[i + 1]] for (x, _), c in zip(held, cuts)])
        if not len(s):
            continue
        d = np.concatenate([x[c[i]:c[i + 1]] for (_, x), c in zip(held, cuts)])
        order = np.argsort(s)
        s, d = s[order], d[order]
        at = np.flatnonzero(np.diff(s, prepend=~s[:1]) != 0)
        lead = np.repeat(np.minimum.reduceat(d, at), np.diff(np.append(at, len(d))))
        node, root = roots(np.concatenate([node, d[d != lead]]), np.concatenate([root, lead[d != lead]]))
    return node, root


def _small(df: DataFrame, rows: int) -> DataFrame:
    """Broadcast hint for a side whose counted rows have a bounded size."""
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def components(docs: DataFrame, k: int = 5, num: int = 80, den: int = 100,
               doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_shingles long, component_id long): one row for each input row.

    Words are separated by ASCII white space, A-Z lower-cased.  A text with
    fewer than k words has its whole word sequence as its one shingle; null
    and empty texts have none and link with nothing.  Rows that share a
    doc_id are one document.  Rows without doc_id link with nothing and have
    no component.  Other columns are not read.  The result is a stored table;
    the intermediate ones are removed.
    """
    _, size = text_size(docs, text)
    # a set sends a signature for each class of two bands, some 2.5 times the
    # shingles in which linked sets of its size may differ
    shards = max(8, ceil(size / 6 * 2.5 * (den - num) / num / SHARD))
    base = docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).cast("string").alias("text"))
    with Scratch(docs.sparkSession) as scratch:
        return stored(_components(base, k, num, den, shards, doc_id, scratch.stored), "linked")


def _components(base: DataFrame, k: int, num: int, den: int, shards: int, doc_id: str, store) -> DataFrame:
    # a bounded list: a few megabytes at most
    common = base.sparkSession.sparkContext.broadcast(common_shingles(base, k))
    task, ddl = _collect(k, num, den, shards, common)
    found = store(base.mapInArrow(task, ddl), "shingles")
    rows = found.where("kind = 0").select("id", "n", "fp0", "fp1")

    # exact copies of a set: the smallest id stands for the class.  Classes of
    # more than a thousandth of the rows, so at most a thousand, are broadcast
    known = rows.where("n > 0 and id is not null").select("id", "fp0", "fp1")
    lead = known.groupBy("fp0", "fp1").agg(F.min("id").alias("rep"), F.max("id").alias("last"), F.count(F.lit(1)).alias("m"))
    lead = store(lead.where("rep <> last").drop("last"), "classes")
    many = F.col("m") > known.count() / HOT_SHARE
    hot, fp = F.broadcast(lead.where(many).drop("m")), ["fp0", "fp1"]
    member = known.join(hot, fp).unionByName(
        known.join(hot.select(fp), fp, "left_anti").join(lead.where(~many).drop("m"), fp))
    member = store(member.select("id", "rep").distinct(), "copies")

    # candidate families
    pair_ddl, pair = "a long, b long", _arrow("a long, b long")

    def stars(key, table):
        node, root = _stars(table)
        return pa.Table.from_arrays([pa.array(node), pa.array(root)], schema=pair)

    def here(batches):
        for b in batches:
            for r in b.to_pylist():
                yield pa.RecordBatch.from_arrays([pa.array(A.unpack(r["sigs"], r["size"], np.int64)),
                                                  pa.array(A.unpack(r["ids"], r["size"], np.int64))], schema=pair)

    near = found.where("kind = 1").select("shard", "size", "sigs", "ids").groupBy("shard").applyInArrow(stars, pair_ddl) \
        .union(found.where("kind = 2").select("size", "sigs", "ids").mapInArrow(here, pair_ddl))
    same = member.select(F.col("id").alias("a"), F.col("rep").alias("b"))
    family = connected_components(near.union(same), store)
    # of exact copies only the smallest id is compared
    family = store(family.join(same.where("a <> b").select(F.col("a").alias("node")), "node", "left_anti"), "families")
    links = _links(base, family, k, num, den, store)

    comp = store(connected_components(links.union(same), store), "components")
    out = rows.join(comp.withColumnRenamed("node", "id"), "id", "left")
    return out.select(F.col("id").alias(doc_id), F.col("n").alias("n_shingles"),
                      F.coalesce("component", "id").alias("component_id"))


def keep_one(docs: DataFrame, k: int = 5, num: int = 80, den: int = 100,
             doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """docs with one row of each group of linked documents: the smallest
    doc_id.  Rows equal in doc_id and text count once (kept: the row whose
    other columns have the smallest hash); rows that share a doc_id but hold
    different texts are documents of their own.  Rows without doc_id or
    without words stay; an empty table stays empty, texts of any length are
    compared whole, and input columns keep their values whatever their names."""
    known = docs.where(F.col(doc_id).isNotNull())
    if not known.groupBy(doc_id).count().where("count > 1").head(1):
        return _without_linked(docs, components(docs, k, num, den, doc_id, text), doc_id).select(docs.columns)
    # the stage is keyed by the row's place in the order of (doc_id, text)
    others = [c for c in docs.columns if c not in (doc_id, text)]
    hashes = [F.xxhash64(*others), F.xxhash64(F.reverse(F.to_json(F.struct(*others))))] if others else [F.lit(0)]
    one = known.groupBy(doc_id, text).agg(F.min_by(F.struct(*docs.columns), F.struct(*hashes)).alias("__kept"))
    row = "row"
    while row in {c.lower() for c in docs.columns}:
        row += "_"
    rows = one.select("__kept.*").orderBy(doc_id, F.xxhash64(text), text).withColumn(row, F.monotonically_increasing_id())
    rows = stored(rows, "rows")
    left = _without_linked(rows, components(rows, k, num, den, row, text), row).select(docs.columns)
    return left.unionByName(docs.where(F.col(doc_id).isNull()))


def _without_linked(docs: DataFrame, found: DataFrame, key: str) -> DataFrame:
    gone = found.where(F.col(key) != F.col("component_id")).select(key).distinct()
    return docs.join(_small(gone, gone.count()), key, "left_anti")


def _links(base: DataFrame, family: DataFrame, k: int, num: int, den: int, store) -> DataFrame:
    """Links (a, b) that join the same documents as all links within families."""
    sizes = family.groupBy("component").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    total = sizes.agg(F.sum("size").alias("n"), F.max("size").alias("top"),
                      F.sum(F.when(F.col("size") > FAMILY, F.col("size"))).alias("large")).first()
    n = int(total["n"] or 0)
    family = family.join(sizes, "component").select(F.col("node").alias("id"), F.col("component").alias("family"), "size")
    texts = base.join(_small(family, n), "id").select("id", "family", "size", "text")
    # rows that share an id are one document with one of their texts
    pair_ddl, pair = "a long, b long", _arrow("a long, b long")

    def inside(key, table):
        table = table.take(pa.compute.sort_indices(table.select(["family", "id"]),
                                                   [("family", "ascending"), ("id", "ascending")]))
        sh = Shingles(table.column("text"), k)
        fam, ids = table.column("family").to_numpy(), table.column("id").to_numpy()
        out = []
        cut = np.flatnonzero(np.diff(fam, prepend=fam[:1] - 1))
        for a, b in zip(cut, np.append(cut[1:], len(fam))):
            out += [(ids[a + i], ids[a + j]) for i, j in region_links([sh.set(x) for x in range(a, b)], num, den)]
        p = np.array(out, np.int64).reshape(-1, 2)
        return pa.Table.from_arrays([pa.array(x) for x in roots(p[:, 0], p[:, 1])], schema=pair)

    bins = max(1, ceil(n / (4 * FAMILY)))
    if total["large"]:
        texts = store(texts, "members")
    small = texts.where(F.col("size") <= FAMILY).withColumn("bin", F.pmod(F.xxhash64("family"), F.lit(bins)))
    links = store(small.select("bin", "family", "id", "text").groupBy("bin").applyInArrow(inside, pair_ddl), "links")
    if total["large"]:
        links = links.union(_large_links(texts.where(F.col("size") > FAMILY), k, num, den, store))
    return links


def _large_links(members: DataFrame, k: int, num: int, den: int, store) -> DataFrame:
    """Links within families too large for a task, by blocks of pivots."""
    pair_ddl, pair = "a long, b long", _arrow("a long, b long")
    large = members.select("family", F.pmod(F.xxhash64("id"), F.ceil(F.col("size") / FAMILY)).cast("int").alias("part"),
                           "id", "text")
    parts = large.select("family", "part").distinct()
    who = large.select("id", "family").distinct()

    def block(key, table, pivots):
        if not table.num_rows or not pivots.num_rows:
            return pair.empty_table()
        sh, ids = Shingles(table.column("text"), k), table.column("id").to_numpy()
        region = Region([sh.set(i) for i in range(len(ids))], num, den)
        a, b = [], []
        for pack in (c[i].values for c in pivots.column("own").chunks for i in range(len(c))):
            ps, pid = Shingles(pack.field("text"), k), pack.field("id").to_numpy()
            hits = []
            for j in range(len(pid)):
                s = ps.set(j)
                at = np.minimum(np.searchsorted(region.universe, s), len(region.universe) - 1)
                hits.append(ids[region.against(region.common(at[region.universe[at] == s]), len(s))[1]])
            # a star for each component of these links
            node, root = roots(np.concatenate(hits), np.repeat(pid, [len(h) for h in hits]))
            a.append(node)
            b.append(root)
        return pa.Table.from_arrays([pa.array(x) for x in roots(np.concatenate(a), np.concatenate(b))], schema=pair)

    links, done, width, round_ = None, None, FIRST_BLOCK, 0
    while True:
        open_ = who
        if links is not None:   # documents outside the largest component of their family
            comp = connected_components(links, store).withColumnRenamed("node", "id")
            part = store(who.join(comp, "id", "left").select("id", "family", F.coalesce("component", "id").alias("c")), "parts")
            most = part.groupBy("family", "c").agg(F.count(F.lit(1)).alias("n")).groupBy("family") \
                .agg(F.max(F.struct("n", "c")).alias("most")).select("family", F.col("most.c").alias("c"))
            open_ = part.join(most, ["family", "c"], "left_anti").select("id", "family").join(done, "id", "left_anti")
        open_ = store(open_, "open")
        count = open_.groupBy("family").agg(F.count(F.lit(1)).alias("n"))
        if not count.head(1):
            return links
        # about `width` pivots of each family: a cut by hash, so that no task
        # sorts a family; they travel in packs.  Each round has hashes of its
        # own: with the hashes of the round before, all that are open would lie
        # above the cut
        round_ += 1
        hash_ = F.pmod(F.xxhash64("id", F.lit(round_)), F.lit(1 << 30))
        packs = F.ceil(F.least(F.col("n"), F.lit(width)) / PACK).cast("int")
        pivots = store(open_.join(count, "family").where(hash_ * F.col("n") <= F.lit(width << 30))
                        .select("id", "family", F.pmod(F.xxhash64("id"), packs).cast("int").alias("pack")), "pivots")
        blob = large.select("id", "text").join(pivots, "id").groupBy("family", "pack") \
            .agg(F.collect_list(F.struct("id", "text")).alias("own")).join(parts, "family") \
            .select("family", "part", "own").toDF("family", "part", "own")
        new = large.groupBy("family", "part").cogroup(blob.groupBy("family", "part")).applyInArrow(block, pair_ddl)
        links = store(new if links is None else links.union(new), "links")
        done = pivots.select("id") if done is None else store(done.union(pivots.select("id")), "done")
        width = min(width * GROWTH, LARGEST_BLOCK)
