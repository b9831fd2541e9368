"""Ranked lexical search: term at a time, with a limited set of accumulators.

Items (queries) are worked off in blocks of at most ITEM_BYTES of text; a
block's terms and statistics are all that is sent to the tasks.  One pass over
the documents packs an index: for every portion of some megabytes of text, the
postings of the block's terms, with term frequencies and document lengths.  The
number of documents, their terms and the document frequencies are sums over
these portions.

A second pass takes the portions one by one.  An item's terms go rarest first
(by document frequency in the whole table).  Each adds its postings' scores to
the accumulators of the documents they name.  As soon as the sum of the largest
scores that the remaining terms give in this portion cannot reach the kth best
partial score, nor the kth best score of the portions that the task has
finished, no more accumulators are made; those there are go on to be updated
exactly.  A bound equal to the kth score still makes accumulators, so ties are
never lost.  A task returns its k best documents an item; Spark ranks those,
first within hash classes of documents, then an item at a time.

Terms are the maximal runs of ASCII letters and digits and of non-ASCII
characters, A-Z lower-cased; they are matched by 128-bit hashes.  Null texts
have no terms, very long ones are handled whole.  Items that are equal in id
and text count once; items that share an id but not a text are ranked each for
itself.  An item without terms, and a null item id, get what the rule gives: no
rows, and rows under the null id.  Repeated documents are documents of their
own; a null document id counts as the smallest.  Empty tables give an empty
result.  Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import copy
from math import ceil, floor, log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidewatch.llm.arrays import NOT_ALNUM, Words, pack, slices, unpack, utf8
from tidewatch.llm.frames import Scratch
from tidewatch.operators.ranking import top_k

#: text of items that one pass over the documents serves
ITEM_BYTES = 4 << 20
#: text of the documents of a portion of the index
PORTION_BYTES = 4 << 20
#: stands for a null document id
NO_ID = -(1 << 63)
#: hash classes that an item's candidates are first ranked in
CLASSES = 64

_INDEX = ("docs long, tokens long, n_terms int, n_postings int, terms binary, sizes binary, "
          "place binary, tf binary, ids binary, lengths binary")


class Items:
    """Terms of a block of items.

    high, low: halves of the distinct terms' hashes, ascending by high;
    terms[i], times[i]: numbers of item i's terms, and how often it has them.
    """

    def __init__(self, texts: list[str | None]):
        words = Words(*utf8(pa.array(texts, pa.string())), lower=True, gap=NOT_ALNUM)
        both = np.stack([words.hashes(1), words.hashes(2)], axis=1)
        key, code = np.unique(both, axis=0, return_inverse=True) if len(both) else (both, np.zeros(0, int))
        self.high, self.low = key[:, 0].copy(), key[:, 1].copy()
        self.terms, self.times = [], []
        for a, b in zip(words.first[:-1], words.first[1:]):
            t, n = np.unique(code.reshape(-1)[a:b], return_counts=True)
            self.terms.append(t)
            self.times.append(n)

    def find(self, words: Words) -> tuple[np.ndarray, np.ndarray]:
        """(word, term) of the words that are terms of an item."""
        if not len(self.high) or not len(words):
            return np.zeros(0, int), np.zeros(0, int)
        h = words.hashes(1)
        at = np.minimum(np.searchsorted(self.high, h), len(self.high) - 1)
        hit = np.flatnonzero(self.high[at] == h)
        some = copy.copy(words)
        some.start, some.end = words.start[hit], words.end[hit]
        low, at = some.hashes(2), at[hit]
        ok = self.low[at] == low
        # terms that share their high half lie side by side
        while not ok.all():
            more = ~ok & (at + 1 < len(self.high)) & (self.high[np.minimum(at + 1, len(self.high) - 1)] == self.high[at])
            if not more.any():
                break
            at = at + more
            ok |= more & (self.low[at] == low)
        return hit[ok], at[ok]


def _index(items: Items):
    """Portions of documents to packed postings of the items' terms."""
    def portion(part):
        words = Words(*utf8(part.column(1)), lower=True, gap=NOT_ALNUM)
        hit, term = items.find(words)
        n = len(words.count)
        key, tf = np.unique(term * n + words.text[hit], return_counts=True)
        place = (key % max(n, 1)).astype(np.int32)
        terms, sizes = np.unique(key // max(n, 1), return_counts=True)
        return (int((words.count > 0).sum()), len(words), len(terms), len(place), pack(terms.astype(np.int32)),
                pack(sizes.astype(np.int32)), pack(place), pack(tf.astype(np.int32)),
                pack(part.column(0).to_numpy()), pack(words.count.astype(np.int64)), n)

    def run(batches):
        for batch in batches:
            for a, b in slices(batch.column(1), PORTION_BYTES):
                cells = [pa.array([x]) for x in portion(batch.slice(a, b - a))[:-1]]
                cells = [c.cast(pa.int32()) if i in (2, 3) else c for i, c in enumerate(cells)]
                yield pa.RecordBatch.from_arrays([*cells, pa.array([b - a], pa.int32())],
                                                 [*[f.split()[0] for f in _INDEX.split(", ")], "n_rows"])
    return run


def _frequencies(batches):
    """(term, df) of a partition's portions."""
    total = {}
    for b in batches:
        for r in b.to_pylist():
            for t, n in zip(unpack(r["terms"], r["n_terms"], np.int32).tolist(), unpack(r["sizes"], r["n_terms"], np.int32).tolist()):
                total[t] = total.get(t, 0) + n
    yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array(list(total.values()), pa.int64())], ["term", "df"])


def norms(lengths: np.ndarray, docs: int, tokens: int) -> np.ndarray:
    """m of documents with so many terms: 100 - 75 + 75 n N div L."""
    if 75 * int(lengths.max(initial=0)) * docs < 2**63:
        return 25 + 75 * lengths * docs // max(tokens, 1)
    return np.array([25 + 75 * int(n) * docs // tokens for n in lengths], np.int64)


def best(score: np.ndarray, ident: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k best documents, equal scores by ascending id."""
    if len(score) > k:
        low = np.partition(score, len(score) - k)[len(score) - k]
        some = np.flatnonzero(score >= low)
    else:
        some = np.arange(len(score))
    return some[np.lexsort([ident[some], -score[some]])][:k]


class Portion:
    """One portion of the index, scored for items."""

    def __init__(self, row: dict, weight: np.ndarray, docs: int, tokens: int):
        n = row["n_rows"]
        self.ids = unpack(row["ids"], n, np.int64)
        m = norms(unpack(row["lengths"], n, np.int64), docs, tokens)
        terms = unpack(row["terms"], row["n_terms"], np.int32)
        sizes = unpack(row["sizes"], row["n_terms"], np.int32)
        self.place = unpack(row["place"], row["n_postings"], np.int32)
        tf = unpack(row["tf"], row["n_postings"], np.int32).astype(np.int64)
        self.gain = np.repeat(weight[terms], sizes) * (1_000_000_000 * tf // (1000 * tf + 8 * m[self.place]))
        self.first = np.concatenate(([0], np.cumsum(sizes)))
        self.slot = np.full(len(weight), -1)
        self.slot[terms] = np.arange(len(terms))
        self.most = np.maximum.reduceat(self.gain, self.first[:-1]) if len(terms) else np.zeros(0, np.int64)
        self.total, self.open = np.zeros(n, np.int64), np.zeros(n, bool)

    def search(self, terms: np.ndarray, times: np.ndarray, k: int, bar: int) -> tuple[np.ndarray, np.ndarray]:
        """(score, id) of every accumulator above 0.  terms: rarest first;
        bar: a score that k documents have reached elsewhere, or 0."""
        slot = self.slot[terms]
        slot, times = slot[slot >= 0], times[slot >= 0]
        bound = np.cumsum((self.most[slot] * times)[::-1])[::-1]
        own, count, kth, making = [], 0, bar, True
        for s, n, left in zip(slot.tolist(), times.tolist(), bound.tolist()):
            where, gain = self.place[self.first[s]:self.first[s + 1]], self.gain[self.first[s]:self.first[s + 1]] * n
            if making and left < kth:
                making, own = False, np.sort(np.concatenate(own)) if own else np.zeros(0, np.int32)
            if making:
                self.total[where] += gain
                new = where[~self.open[where]]
                self.open[new] = True
                own.append(new)
                count += len(new)
                if count >= k:
                    partial = self.total[np.concatenate(own)]
                    kth = max(kth, int(np.partition(partial, count - k)[count - k]))
            elif len(own):
                at = np.minimum(np.searchsorted(where, own), len(where) - 1)
                hit = where[at] == own
                self.total[own[hit]] += gain[at[hit]]
        own = np.concatenate(own) if making and own else np.asarray(own, np.int32)
        score = self.total[own]
        self.total[own], self.open[own] = 0, False
        return score[score > 0], self.ids[own][score > 0]


def _search(items: Items, weight: np.ndarray, df: np.ndarray, docs: int, tokens: int, k: int):
    """A partition's portions to its k best documents of each item."""
    order = [np.lexsort([t, df[t]]) for t in items.terms]

    def run(batches):
        held = [(np.zeros(0, np.int64), np.zeros(0, np.int64))] * len(items.terms)
        for b in batches:
            for row in b.to_pylist():
                part = Portion(row, weight, docs, tokens)
                for i, o in enumerate(order):
                    had = held[i]
                    found = part.search(items.terms[i][o], items.times[i][o], k, int(had[0][-1]) if len(had[0]) == k else 0)
                    score, ident = (np.concatenate(x) for x in zip(had, found))
                    top = best(score, ident, k)
                    held[i] = score[top], ident[top]
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(np.arange(len(held), dtype=np.int32), [len(s) for s, _ in held])),
             pa.array(np.concatenate([x for _, x in held] or [np.zeros(0, np.int64)])),
             pa.array(np.concatenate([x for x, _ in held] or [np.zeros(0, np.int64)]))], ["item", "id", "score"])
    return run


def _block(docs: DataFrame, items: DataFrame, k: int) -> DataFrame:
    """Best documents of one block of items (item, body)."""
    spark = docs.sparkSession
    own = items.collect()  # at most ITEM_BYTES of text, or one item
    block = Items([r["body"] for r in own])
    scratch = Scratch(spark)
    with scratch:
        index = scratch.stored(docs.mapInArrow(_index(block), _INDEX + ", n_rows int"), "postings")
        n, tokens = index.agg(F.coalesce(F.sum("docs"), F.lit(0)), F.coalesce(F.sum("tokens"), F.lit(0))).first()
        df, weight = np.zeros(len(block.high), np.int64), np.zeros(len(block.high), np.int64)
        counted = index.select("n_terms", "terms", "sizes").mapInArrow(_frequencies, "term int, df long").groupBy("term").agg(F.sum("df").alias("df"))
        for r in counted.collect():  # at most one row a term of the block
            df[r.term], weight[r.term] = r.df, floor(1000 * log((2 * n + 2) / (2 * r.df + 1)))
        found = index.mapInArrow(_search(block, weight, df, n, tokens, k), "item int, id long, score long")
        order = [F.col("score").desc(), F.col("id").asc()]
        found = top_k(found.withColumn("part", F.pmod(F.xxhash64("id"), F.lit(CLASSES))), ["item", "part"], order, k)
        found = Scratch(spark).stored(top_k(found.drop("part", "rank"), ["item"], order, k), "ranked")
    names = spark.createDataFrame([(i, r["item"]) for i, r in enumerate(own)],
                                  items.select(F.lit(0).alias("number"), "item").schema)
    return found.join(F.broadcast(names), found["item"] == names["number"]).select(names["item"], "rank", "id", "score")


def search(docs: DataFrame, items: DataFrame, k: int = 10, doc_id: str = "doc_id", text: str = "text",
           item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """(item_id, rank, doc_id, score): the k documents with the highest
    scores above 0 of each item, equal scores by ascending id."""
    body = F.col(text).cast("string").alias("body")
    docs = docs.select(F.coalesce(F.col(doc_id).cast("long"), F.lit(NO_ID)).alias("id"), body)
    asked = items.select(F.col(item_id).alias("item"), F.col(item_text).cast("string").alias("body")).distinct()
    size = asked.agg(F.coalesce(F.sum(F.octet_length("body")), F.lit(0))).first()[0]
    blocks = max(1, ceil(size / ITEM_BYTES))
    out = None
    for b in range(blocks):
        part = _block(docs, asked.where(F.pmod(F.xxhash64("item", "body"), F.lit(blocks)) == b), k)
        out = part if out is None else out.unionByName(part)
    return out.select(F.col("item").alias(item_id), "rank", F.nullif("id", F.lit(NO_ID)).alias(doc_id), "score")
