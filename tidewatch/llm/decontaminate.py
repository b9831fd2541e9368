"""Benchmark decontamination by spaced-seed hashing.

Tokens are runs of ASCII letters and digits and of non-ASCII characters, A-Z
lower-cased; punctuation and spaces of any script part them, and in scripts
written without spaces every character is a token.  A benchmark item of n tokens
counts as found in a document where some alignment has ``w = min(WINDOW, n)``
consecutive token positions of which at most ``(w - 5) // 5`` differ:
substitutions are tolerated, punctuation and case are ignored.  Items with fewer
than five tokens are found where all their tokens follow each other in the
document; items without tokens are never found.

Seeds are fixed masks that ignore some token positions.  The masks of a window
length are lossless: any window with so many substitutions has a mask that
falls on equal tokens only, so hashing loses no overlap.  Document hashes are
looked up in the hashes of the benchmark; around each hit the alignment is
compared token by token.  The benchmark goes to the tasks in blocks of a fixed
size, one pass over the documents' rows a block; the documents are not shuffled.
"""

from __future__ import annotations

import unicodedata
from functools import lru_cache
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidewatch.llm import arrays as A
from tidewatch.llm.repeats import _arrow

#: aligned tokens that are compared
WINDOW = 20
#: items with fewer tokens are matched exactly
SHORT = 5
#: fixed masks, by the smallest window length that they serve (1: token counts)
MASKS = {5: ("11011",), 6: ("110111", "1111011"), 20: ("11111011", "101011111")}
#: bytes of benchmark text sent to the tasks at once
BLOCK_BYTES = 16 << 20

# First and last code points of scripts that are written without
# spaces (Thai and Lao, Tibetan, Burmese, Khmer, kana, Han).
UNSPACED = [(0x0E00, 0x0EFF), (0x0F00, 0x0FFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x3005, 0x3007),
            (0x3040, 0x30FF), (0x31F0, 0x31FF), (0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF),
            (0xFF66, 0xFF9F), (0x20000, 0x323AF)]

MATCH = "array<struct<item_id:bigint,start:int,end:int,equal:int>>"


def masks_for(window: int) -> tuple[str, ...]:
    return MASKS[max(w for w in MASKS if w <= window)]


def allowed(window: int) -> int:
    return (window - 5) // 5


@lru_cache(maxsize=1)
def _kinds() -> np.ndarray:
    """For each code point from 0x80 on: 0 part of a token, 1 between tokens, 2 a
    token of its own."""
    kind = np.zeros(0x200000, np.int8)
    for a, b in UNSPACED:
        kind[a:b + 1] = 2
    for c in range(0x80, 0x1F000):
        if unicodedata.category(chr(c))[0] in "PZ" or c == 0x200B:
            kind[c] = 1
    return kind


class Tokens(A.Words):
    """Token spans of a block of texts."""

    def __init__(self, data: np.ndarray, offs: np.ndarray):
        self.data, self.offs = A.LOWER[data], offs
        n = len(data)
        gap, edge = A.NOT_ALNUM[data], np.zeros(n + 1, bool)
        edge[offs] = True
        lead = np.flatnonzero(data >= 0xC0)
        size = 2 + (data[lead] >= 0xE0) + (data[lead] >= 0xF0).astype(np.int64)
        whole = lead + size <= n
        lead, size = lead[whole], size[whole]
        code = data[lead].astype(np.int64) & (0x7F >> size)
        for j in (1, 2, 3):
            more = np.flatnonzero(size > j)
            code[more] = code[more] << 6 | data[lead[more] + j] & 0x3F
        kind = _kinds()[code]
        own = kind == 2
        edge[lead[own]] = edge[lead[own] + size[own]] = True
        for j in range(4):
            gap[lead[(kind == 1) & (size > j)] + j] = True
        before, after = np.ones(n, bool), np.ones(n, bool)
        before[1:], after[:-1] = gap[:-1], gap[1:]
        self.start = np.flatnonzero(~gap & (before | edge[:-1]))
        self.end = np.flatnonzero(~gap & (after | edge[1:])) + 1
        self.first = np.searchsorted(self.start, offs)
        self.count = np.diff(self.first)


def _tokens(column) -> Tokens:
    return Tokens(*A.utf8(column))


def _runs(h: np.ndarray, n: int) -> np.ndarray:
    """Hash of the n tokens at each position."""
    return _seeds(h, "1" * n)


def _seeds(h: np.ndarray, mask: str) -> np.ndarray:
    """Hash of the unmasked tokens at each position."""
    m = len(h) - len(mask) + 1
    if m <= 0:
        return np.zeros(0, np.uint64)
    acc = np.zeros(m, np.uint64)
    for mult, j in zip(A.multipliers(len(mask), 31), (j for j, c in enumerate(mask) if c == "1")):
        acc += h[j:j + m] * mult
    return A.mix(acc)


class Index:
    """Seeds of one block of benchmark items."""

    def __init__(self, ids: list, texts: list, window: int):
        w = _tokens(pa.array(texts, pa.string()))
        h = w.hashes(30)
        self.ids, self.window = ids, window
        self.items = [h[a:b] for a, b in zip(w.first[:-1], w.first[1:])]
        self.tables = {}
        for mask in {m for ms in MASKS.values() for m in ms}:
            rows = [(i, _seeds(t, mask)) for i, t in enumerate(self.items)
                    if len(t) >= SHORT and mask in masks_for(min(window, len(t)))]
            rows = [(i, s) for i, s in rows if len(s)]
            if rows:
                seed = np.concatenate([s for _, s in rows])
                item = np.concatenate([np.full(len(s), i) for i, s in rows])
                place = np.concatenate([np.arange(len(s)) for _, s in rows])
                order = np.argsort(seed, kind="stable")
                seed = seed[order]
                bits = np.zeros(1 << 20, bool)
                bits[(seed & np.uint64((1 << 20) - 1)).astype(np.int64)] = True
                self.tables[mask] = (seed, item[order], place[order], bits)
        # short items by their whole token sequence; equal ones share an entry
        self.short = {}
        for n in range(1, SHORT):
            own = [i for i, t in enumerate(self.items) if len(t) == n]
            if own:
                keys, code = np.unique([_runs(self.items[i], n)[0] for i in own], return_inverse=True)
                self.short[n] = (keys, [[own[j] for j in np.flatnonzero(code == c)] for c in range(len(keys))])

    def short_hits(self, w: Tokens, h: np.ndarray, doc_of: np.ndarray):
        """(text, item, token position, tokens) of the first place of each short
        item in each text."""
        for n, (keys, items) in self.short.items():
            run = _runs(h, n)
            code = np.minimum(np.searchsorted(keys, run), len(keys) - 1)
            at = np.flatnonzero((keys[code] == run) & w.has_window(n)[:len(run)])
            _, first = np.unique(doc_of[at] * len(keys) + code[at], return_index=True)
            for place in at[first].tolist():
                doc = int(doc_of[place])
                for i in items[code[place]]:
                    if (h[place:place + n] == self.items[i]).all():
                        yield doc, i, place - int(w.first[doc]), n

    def hits(self, h: np.ndarray, mask: str):
        """(token position, item, item position) of equal seeds."""
        seed, item, place, bits = self.tables[mask]
        s = _seeds(h, mask)
        at = np.flatnonzero(bits[(s & np.uint64((1 << 20) - 1)).astype(np.int64)])
        lo, hi = np.searchsorted(seed, s[at], "left"), np.searchsorted(seed, s[at], "right")
        n = hi - lo
        own = np.repeat(lo, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        return np.repeat(at, n), item[own], place[own]

    def overlap(self, doc: np.ndarray, item: int, shift: int):
        """Best window of the alignment doc[shift + j] ~ item[j]: (start, end,
        equal tokens) in the document, or None."""
        t = self.items[item]
        w = min(self.window, len(t))
        a, b = max(0, -shift), min(len(t), len(doc) - shift)
        if b - a < w:
            return None
        same = np.cumsum(np.concatenate(([0], (doc[a + shift:b + shift] == t[a:b]).astype(np.int64))))
        run = same[w:] - same[:-w]
        good = np.flatnonzero(run >= w - allowed(w))
        if not len(good):
            return None
        lo, hi = int(good[0]), int(good[-1]) + w
        return a + shift + lo, a + shift + hi, int(same[hi] - same[lo])

    def search(self, column) -> list[list[dict]]:
        w = _tokens(column)
        h, doc_of = w.hashes(30), w.text
        found = [np.zeros((0, 3), np.int64)]
        for mask in self.tables:
            at, item, place = self.hits(h, mask)
            doc = doc_of[at]
            inside = at + len(mask) <= w.first[doc + 1]
            found.append(np.stack([doc, item, at - w.first[doc] - place], 1)[inside])
        out: list[dict] = [{} for _ in range(len(w.count))]     # without seeds nothing is found
        for doc, item, shift in np.unique(np.concatenate(found), axis=0).tolist():
            r = self.overlap(h[w.first[doc]:w.first[doc + 1]], item, shift)
            if r and (item not in out[doc] or r[2] > out[doc][item]["equal"]):
                out[doc][item] = {"item_id": self.ids[item], "start": r[0], "end": r[1], "equal": r[2]}
        for doc, item, place, n in self.short_hits(w, h, doc_of):
            out[doc][item] = {"item_id": self.ids[item], "start": place, "end": place + n, "equal": n}
        return [[o[i] for i in sorted(o)] for o in out]


def find_items(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, text: str = "text",
               item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """docs with ``matches``: for each benchmark item found, its id, the token
    span of the best alignment (of a short item, its first place) and the equal
    tokens in it; empty for clean documents.  Null and empty texts are clean;
    very long ones are searched whole; rows are judged one by one, so
    repeated rows get the same result.  An input column named matches is
    replaced; an empty benchmark finds nothing.
    """
    items = benchmark.where(F.col(item_text).isNotNull()).select(
        F.col(item_id).cast("long").alias("i"), F.col(item_text).cast("string").alias("t"))
    size = items.agg(F.coalesce(F.sum(F.octet_length("t")), F.lit(0))).first()[0]
    blocks = max(1, ceil(size / BLOCK_BYTES))
    docs = docs.drop("matches")
    out = docs.withColumn("matches", F.lit(None).cast(MATCH))
    schema = out.schema
    arrow = _arrow(f"m {MATCH}").field("m").type
    at, body = len(docs.columns), docs.columns.index(text)

    for b in range(blocks):
        rows = items.where(F.pmod(F.xxhash64("t"), F.lit(blocks)) == b).orderBy("i", "t").collect()
        sent = docs.sparkSession.sparkContext.broadcast(([r["i"] for r in rows], [r["t"] for r in rows]))

        def search(batches, sent=sent):
            index = None
            for batch in batches:
                index = index or Index(*sent.value, window)
                col = batch.column(body).cast(pa.string())
                got = [m for a, b in A.slices(col) for m in index.search(col.slice(a, b - a))]
                old = batch.column(at).to_pylist()
                cols = batch.columns[:at] + [pa.array([(o or []) + g for o, g in zip(old, got)], arrow)]
                yield pa.RecordBatch.from_arrays(cols, names=batch.schema.names)

        out = out.mapInArrow(search, schema)
    return out


def clean(docs: DataFrame, benchmark: DataFrame, **args) -> DataFrame:
    """docs without the rows in which a benchmark item is found."""
    return find_items(docs, benchmark, **args).where(F.size("matches") == 0).select(docs.columns)
