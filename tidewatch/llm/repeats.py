"""Removal of word windows that occur earlier in the corpus.

Common ground of substring de-duplication (`substring_dedup`) and suffix-array
de-duplication (`suffix_dedup`).  Rule of both: a window is ``n`` consecutive
words of one document; each word covered by a window whose word sequence also
starts earlier (smaller doc_id, or same document and earlier start) goes.

Plan.  Documents are dealt into chunks of a few megabytes by a hash of their
content, so every chunk looks alike whatever the skew of the input.

1. A chunk sends *probes* of its distinct windows, packed by hash shard; a
   shard answers with one bit a probe: may occur in another place.  The two
   operators differ only here.
2. For windows with that bit, or seen twice in the chunk, the chunk sends its
   first occurrence under a 128-bit fingerprint; the shard sorts all chunks'
   entries and answers for each whether a smaller (doc_id, position) exists.
3. The chunk removes what such windows cover.

A frequent window costs one entry a chunk, however often it occurs, so no
group of copies meets in one task.  The three steps are one lazy plan; the
text is shuffled once, as Spark reuses the exchange, and a lost executor's
shuffle files are recomputed from the input.
"""

from __future__ import annotations

from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StructType

from tidewatch.llm import arrays as A
from tidewatch.llm.frames import chunk_plan, chunked, text_size

NULL_ID = -2**63
SPANS = "array<struct<start:int,end:int>>"


class Windows:
    """The n-word windows of one chunk, documents in (id, text) order."""

    def __init__(self, table: pa.Table, n: int):
        ids = table.column("id").fill_null(NULL_ID)
        table = table.set_column(table.column_names.index("id"), "id", ids)
        table = table.take(pa.compute.sort_indices(
            table.select(["id", "text"]), [("id", "ascending"), ("text", "ascending")]))
        self.table, self.n = table, n
        self.ids = table.column("id").to_numpy()
        self.words = A.Words(*A.utf8(table.column("text")))
        self.hash = self.words.hashes(1)
        self.at = np.flatnonzero(self.words.has_window(n))
        self.key = A.windows(self.hash, n, 2)[self.at]
        self.order, self.new = A.groups(self.key)

    def repeated_here(self) -> np.ndarray:
        """True for each window whose key occurs more than once in the chunk."""
        many = ~self.new
        many[:-1] |= ~self.new[1:]
        out = np.empty(len(many), bool)
        out[self.order] = many
        return out

    def exact(self, some: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For a subset of windows: second key, and the order and group starts
        by both keys (inside a group by position)."""
        if not len(some):
            return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, bool)
        second = A.windows(self.words.hashes(3), self.n, 4)[self.at[some]]
        order, new = A.groups(self.key[some], second)
        return second, order, new


# ---------------------------------------------------------------- probes
class CountMin:
    """Count-min prefilter: two rows of counters, cut into hash shards.

    A chunk adds one to a cell of each row for each distinct window; a shard
    merges the chunks' sketches and the minimum of a window's two counters
    overestimates how many chunks hold it.  There are four cells a window, so
    about one unrepeated window in twenty is kept for the exact pass.  Cells
    travel as sorted steps, some one and a half bytes each.
    """

    send = "n int, cells0 binary, cells1 binary"
    answer = "n int, bits0 binary, bits1 binary"

    def __init__(self, cells: int):
        self.cells = cells

    def probes(self, w: Windows) -> np.ndarray:
        return w.key

    def cell(self, u: np.ndarray, row: int) -> np.ndarray:
        return A.mix(u ^ np.uint64(0x5851F42D4C957F2D * (row + 1) % 2**64)) % np.uint64(self.cells)

    def pack(self, u: np.ndarray) -> dict:
        return {"n": len(u), "cells0": A.pack_sorted(np.sort(self.cell(u, 0).astype(np.uint32))),
                "cells1": A.pack_sorted(np.sort(self.cell(u, 1).astype(np.uint32)))}

    def merge(self, rows: list[dict]) -> list[dict]:
        out = [{"n": r["n"]} for r in rows]
        for k in (0, 1):
            cells = [A.unpack_sorted(r[f"cells{k}"], r["n"], np.uint32) for r in rows]
            twice = np.bincount(np.concatenate(cells), minlength=self.cells) >= 2
            for o, c in zip(out, cells):
                o[f"bits{k}"] = np.packbits(twice[c]).tobytes()
        return out

    def hits(self, u: np.ndarray, row: dict) -> np.ndarray:
        hit = np.ones(len(u), bool)
        for k in (0, 1):
            bits = np.unpackbits(np.frombuffer(row[f"bits{k}"], np.uint8), count=len(u)).astype(bool)
            own = np.empty(len(u), bool)
            own[np.argsort(self.cell(u, k).astype(np.uint32), kind="stable")] = bits
            hit &= own
        return hit


class SparseSuffixes:
    """Seed prefilter in place of a sparse suffix array.

    Of the ``n - seed + 1`` positions at which ``seed`` words of a window can
    begin, the one with the smallest hash is kept (a content-selected
    minimiser, so equal windows keep the same seed).  Shards group the 64-bit
    hashes of the seeds of all chunks; a seed that occurs twice makes the
    windows around it candidates, which the exact pass compares as a whole.
    """

    send = "n int, suffixes binary"
    answer = "n int, bits binary"

    def __init__(self, n: int, seed: int):
        self.reach, self.seed = n - seed + 1, seed

    def probes(self, w: Windows) -> np.ndarray:
        grams = A.windows(w.hash, self.seed, 5)
        return A.sliding_min(grams, self.reach)[w.at]

    def pack(self, u: np.ndarray) -> dict:
        return {"n": len(u), "suffixes": A.pack_sorted(u)}

    def merge(self, rows: list[dict]) -> list[dict]:
        own = [A.unpack_sorted(r["suffixes"], r["n"], np.uint64) for r in rows]
        every = np.concatenate(own)
        order, new = A.groups(every)
        like = ~new
        like[:-1] |= ~new[1:]
        hit = np.empty(len(every), bool)
        hit[order] = like
        cut = np.cumsum([len(x) for x in own])[:-1]
        return [{"n": r["n"], "bits": np.packbits(h).tobytes()}
                for r, h in zip(rows, np.split(hit, cut))]

    def hits(self, u: np.ndarray, row: dict) -> np.ndarray:
        return np.unpackbits(np.frombuffer(row["bits"], np.uint8), count=len(u)).astype(bool)


# ---------------------------------------------------------------- steps
def _rows(table: pa.Table) -> list[dict]:
    return table.to_pylist()


def _table(rows: list[dict], schema: pa.Schema) -> pa.Table:
    return pa.Table.from_pylist(rows, schema=schema)


def _arrow(ddl: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    return to_arrow_schema(StructType.fromDDL(ddl))


def _cut(sorted_values: np.ndarray, shards: int):
    """(shard, from, to) of each shard that has values."""
    s = A.shard_of(sorted_values, shards)
    at = np.flatnonzero(np.diff(s, prepend=np.uint64(2**63)))
    for a, b in zip(at, np.append(at[1:], len(s))):
        yield int(s[a]), int(a), int(b)


def _candidates(w: Windows, probe, answers: dict[int, dict], shards: int) -> np.ndarray:
    """Windows (indices) that may also occur elsewhere."""
    v = probe.probes(w)
    u, back = np.unique(v, return_inverse=True)
    hit = np.zeros(len(u), bool)
    for s, a, b in _cut(u, shards):
        if s in answers:
            hit[a:b] = probe.hits(u[a:b], answers[s])
    return np.flatnonzero(hit[back] | w.repeated_here())


def repeated_words(docs: DataFrame, n: int, prefilter, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of docs with ``text`` cut down, and n_words, n_removed (long)
    and spans (removed word ranges, end exclusive) after its columns.

    Texts without removed words stay as they are (null stays null); in others
    the kept words are joined by one space.  Input columns named n_words,
    n_removed or spans are replaced.  Rows that share a doc_id count as
    documents of their own, in a fixed order that their content gives (chunks,
    dealt by a hash of it, in turn; within a chunk by text); a null doc_id is
    smaller than any other.  An empty table stays empty; a very long text is
    read whole, by one task, and its size bounds that task's memory.
    """
    docs = docs.drop("n_words", "n_removed", "spans")
    _, size = text_size(docs, text)
    chunks, shards = chunk_plan(size)
    probe = prefilter(max(1, ceil(4 * size / 6 / shards)))
    base = chunked(docs, chunks, doc_id, text, rest=True)

    send = "shard int, chunk int, " + probe.send
    send_schema = _arrow(send)

    def sketch(key, table):
        w = Windows(table, n)
        u = np.unique(probe.probes(w))
        return _table([{"shard": s, "chunk": key[0].as_py(), **probe.pack(u[a:b])}
                       for s, a, b in _cut(u, shards)], send_schema)

    answer = "chunk int, shard int, " + probe.answer
    answer_schema = _arrow(answer)

    def merge(key, table):
        rows = _rows(table)
        return _table([{"chunk": r["chunk"], "shard": key[0].as_py(), **m}
                       for r, m in zip(rows, probe.merge(rows))], answer_schema)

    answers = (base.groupBy("chunk").applyInArrow(sketch, send)
               .groupBy("shard").applyInArrow(merge, answer))

    entry = "shard int, chunk int, n int, key0 binary, key1 binary, ids binary, places binary"
    entry_schema = _arrow(entry)

    def entries(key, table, told):
        if not table.num_rows:
            return _table([], entry_schema)
        w = Windows(table, n)
        some = _candidates(w, probe, {r["shard"]: r for r in _rows(told)}, shards)
        second, order, new = w.exact(some)
        first = order[new]                      # earliest of each distinct window
        at = w.at[some[first]]
        key0, ids = w.key[some[first]], w.ids[w.words.text[at]]
        return _table([{"shard": s, "chunk": key[0].as_py(), "n": b - a,
                        "key0": A.pack_sorted(key0[a:b]), "key1": A.pack(second[first[a:b]]),
                        "ids": A.pack(ids[a:b]), "places": A.pack(at[a:b].astype(np.int32))}
                       for s, a, b in _cut(key0, shards)], entry_schema)

    later = "chunk int, n int, places binary"
    later_schema = _arrow(later)

    def decide(key, table):
        rows = _rows(table)
        col = lambda name, kind, f=A.unpack: np.concatenate([f(r[name], r["n"], kind) for r in rows])
        key0, key1 = col("key0", np.uint64, A.unpack_sorted), col("key1", np.uint64)
        ids, places = col("ids", np.int64), col("places", np.int32)
        chunk = np.repeat([r["chunk"] for r in rows], [r["n"] for r in rows])
        order = np.lexsort((places, chunk, ids, key1, key0))
        k0, k1 = key0[order], key1[order]
        late = np.zeros(len(order), bool)
        late[order[1:]] = (k0[1:] == k0[:-1]) & (k1[1:] == k1[:-1])
        out, at = [], 0
        for r in rows:
            p = np.sort(places[at:at + r["n"]][late[at:at + r["n"]]])
            at += r["n"]
            if len(p):
                out.append({"chunk": r["chunk"], "n": len(p), "places": A.pack_sorted(p)})
        return _table(out, later_schema)

    told = (base.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(entries, entry)
            .groupBy("shard").applyInArrow(decide, later))

    rest = base.schema["rest"].dataType.simpleString()
    result = f"id long, text string, n_words long, n_removed long, spans {SPANS}, rest {rest}"
    result_schema = _arrow(result)

    def remove(key, table, told):
        if not table.num_rows:
            return _table([], result_schema)
        w = Windows(table, n)
        late = np.zeros(len(w.words), bool)
        for r in _rows(told):
            late[A.unpack_sorted(r["places"], r["n"], np.int32)] = True
        # windows equal to a late one, and all but the first of those seen here twice
        some = np.flatnonzero(w.repeated_here() | late[w.at])
        _, order, new = w.exact(some)
        group = np.cumsum(new) - 1
        at = w.at[some[order]]
        gone = late[at[new]][group] | ~new if len(order) else np.zeros(0, bool)
        edge = np.zeros(len(w.words) + 1, np.int64)
        np.add.at(edge, at[gone], 1)
        np.add.at(edge, at[gone] + n, -1)
        cut = np.cumsum(edge[:-1]) > 0
        return _cut_texts(w, cut, result_schema)

    out = base.groupBy("chunk").cogroup(told.groupBy("chunk")).applyInArrow(remove, result)
    names = [f"rest.`{c}`" for c in docs.columns if c not in (doc_id, text)]
    ident = F.when(F.col("id") != NULL_ID, F.col("id")).alias(doc_id)
    body = F.when(~F.col("rest.__null") | (F.col("n_words") > 0), F.col("text")).alias(text)
    cols = {doc_id: ident, text: body} | {n.split("`")[1]: F.col(n) for n in names}
    return out.select(*(cols[c] for c in docs.columns), "n_words", "n_removed", "spans")


def _cut_texts(w: Windows, cut: np.ndarray, schema: pa.Schema) -> pa.Table:
    total = np.concatenate(([0], np.cumsum(cut)))
    first = w.words.first
    removed = total[first[1:]] - total[first[:-1]]
    texts = w.table.column("text").to_pylist()
    spans: list[list] = [[] for _ in texts]
    for i in np.flatnonzero(removed):
        own = cut[first[i]:first[i + 1]]
        words = w.words.list(i)
        texts[i] = b" ".join(x for x, c in zip(words, own) if not c).decode("utf-8", "replace")
        flip = np.flatnonzero(np.diff(own.astype(np.int8), prepend=0, append=0))
        spans[i] = [{"start": int(a), "end": int(b)} for a, b in flip.reshape(-1, 2)]
    return pa.table({"id": pa.array(w.ids), "text": pa.array(texts, pa.string()),
                     "n_words": pa.array(w.words.count.astype(np.int64)),
                     "n_removed": pa.array(removed.astype(np.int64)),
                     "spans": pa.array(spans, schema.field("spans").type),
                     "rest": w.table.column("rest").combine_chunks()}, schema=schema) \
        if len(texts) else _table([], schema)
