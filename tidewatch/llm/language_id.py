"""Language identification of mixed-language texts.

Words are runs of letters of one script.  Script ranges narrow the candidate
languages of a word to those that use its script; each candidate scores the
word by its character trigrams; a Viterbi pass over the words, with a penalty
for switching, labels spans of one language.  The document's language is the
one whose spans hold most letters.

Trigram and script counts of all labelled documents are added up by Spark; the
model has BUCKETS rows and a column a language, whatever the corpus.
"""

from __future__ import annotations

import unicodedata
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidewatch.llm import arrays as A
from tidewatch.llm.frames import stored
from tidewatch.llm.repeats import _arrow

BUCKETS = 1 << 16
#: letters handled at once
BLOCK_CHARS = 500_000
#: bytes of text whose words advance together through the Viterbi pass
VITERBI_BYTES = 8 << 20
#: log-probability lost at a change of language between two words
SWITCH = 8.0
#: added to each trigram count
SMOOTH = 0.1
#: a language is a candidate for a script that has this share of its letters
SCRIPT_SHARE = 1e-3
#: most languages that a model may have
MAX_LANGUAGES = 512

# First code points of Unicode ranges and the script that begins
# there (0 other, 1 Latin, 2 Greek, 3 Cyrillic, 4 Armenian, 5 Hebrew, 6 Arabic,
# 7 Devanagari, 8 other Indic, 9 Thai and Lao, 10 Tibetan and Burmese,
# 11 Georgian, 12 Hangul, 13 Ethiopic, 14 Khmer, 15 Mongolian, 16 Hiragana,
# 17 Katakana, 18 Han).
SCRIPTS = [(0x0000, 1), (0x0370, 2), (0x0400, 3), (0x0530, 4), (0x0590, 5), (0x0600, 6), (0x0900, 7),
           (0x0980, 8), (0x0E00, 9), (0x0F00, 10), (0x10A0, 11), (0x1100, 12), (0x1200, 13), (0x1380, 0),
           (0x1780, 14), (0x1800, 15), (0x18B0, 0), (0x1C80, 3), (0x1C90, 11), (0x1CC0, 0), (0x1E00, 1),
           (0x1F00, 2), (0x2000, 0), (0x2C60, 1), (0x2C80, 0), (0x3040, 16), (0x30A0, 17), (0x3100, 0),
           (0x3130, 12), (0x3190, 0), (0x31F0, 17), (0x3200, 0), (0x3400, 18), (0xA000, 0), (0xA720, 1),
           (0xA800, 0), (0xAC00, 12), (0xD800, 0), (0xF900, 18), (0xFB00, 1), (0xFB13, 4), (0xFB1D, 5),
           (0xFB50, 6), (0xFE00, 0), (0xFE70, 6), (0xFF00, 1), (0xFF66, 17), (0xFFA0, 12), (0xFFE0, 0),
           (0x1F1E6, 0), (0x20000, 18), (0x323B0, 0)]
N_SCRIPTS = 19


@lru_cache(maxsize=1)
def _characters() -> tuple[np.ndarray, np.ndarray]:
    """For each code point: lower case, and script (-1: not a letter)."""
    low = np.arange(0x110000, dtype=np.uint32)
    script = np.full(0x110000, -1, np.int8)
    starts = [s for s, _ in SCRIPTS]
    for c in range(0x33500):
        ch = chr(c)
        if unicodedata.category(ch)[0] == "L":
            script[c] = SCRIPTS[int(np.searchsorted(starts, c, "right")) - 1][1]
            if len(ch.lower()) == 1:
                low[c] = ord(ch.lower())
    return low, script


class Letters:
    """Words of a block of texts: letter runs of one script."""

    def __init__(self, texts: list):
        low, kind = _characters()
        size = np.array([len(t) for t in texts], np.int64)
        code = np.frombuffer("".join(texts).encode("utf-32-le", "replace"), np.uint32)
        script = kind[code]
        at = np.flatnonzero(script >= 0)
        off = np.concatenate(([0], np.cumsum(size)))
        self.place = at
        doc = np.searchsorted(off, at, "right") - 1
        s = script[at]
        new = np.ones(len(at), bool)
        new[1:] = (np.diff(at) != 1) | (np.diff(doc) != 0) | (np.diff(s) != 0)
        self.letter = low[code[at]].astype(np.uint64)
        self.new = new
        self.first = np.flatnonzero(new)
        self.length = np.diff(np.append(self.first, len(at)))
        self.doc, self.script = doc[self.first], s[self.first].astype(np.int64)
        self.start = at[self.first] - off[self.doc]

    def trigrams(self) -> np.ndarray:
        """Bucket of the trigram around each letter, word edges included."""
        before = np.zeros(len(self.letter), np.uint64)
        after = np.zeros(len(self.letter), np.uint64)
        inner = ~self.new
        before[1:] = self.letter[:-1]
        before[self.new] = 0
        after[:-1][inner[1:]] = self.letter[1:][inner[1:]]
        key = (before << np.uint64(42)) + (self.letter << np.uint64(21)) + after
        return (A.mix(key) & np.uint64(BUCKETS - 1)).astype(np.int64)


def _blocks(texts: list):
    """(from, to) of runs of texts with a bounded number of characters."""
    a = held = 0
    for i, t in enumerate(texts):
        if held and held + len(t) > BLOCK_CHARS:
            yield a, i
            a, held = i, 0
        held += len(t)
    if a < len(texts):
        yield a, len(texts)


class Model:
    """langs; score[bucket, lang]: log-probability of a trigram; usable[script, lang];
    left_out: languages of the corpus that the model does not have."""

    def __init__(self, langs: list[str], grams: np.ndarray, scripts: np.ndarray, left_out: int = 0):
        self.langs, self.left_out = langs, left_out
        total = grams.sum(axis=0) + SMOOTH * BUCKETS
        self.score = np.log((grams + SMOOTH) / total).astype(np.float32) if langs else grams.astype(np.float32)
        share = scripts / np.maximum(scripts.sum(axis=0), 1)
        self.usable = share >= SCRIPT_SHARE
        self.usable[~self.usable.any(axis=1)] = True    # a script never seen rules nobody out


def learn(docs: DataFrame, text: str = "text", lang: str = "lang") -> Model:
    """Model of all rows with text and lang.  No rows give a model without languages.
    Beyond MAX_LANGUAGES values of lang, as in a column of junk, the model has the
    ones with most letters (ties: first by name) and says how many it left out."""
    base = docs.where(F.col(text).isNotNull() & F.col(lang).isNotNull()).select(
        F.col(lang).cast("string").alias("lang"), F.col(text).cast("string").alias("text"))
    ddl = "lang string, bucket int, n long"
    schema = _arrow(ddl)

    def count(batches):
        held: dict[str, np.ndarray] = {}
        for batch in batches:
            langs, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for a, b in _blocks(texts):
                w = Letters(texts[a:b])
                names, code = np.unique(langs[a:b], return_inverse=True)
                of_word = code[w.doc]
                gram = np.bincount(np.repeat(of_word, w.length) * BUCKETS + w.trigrams(),
                                   minlength=len(names) * BUCKETS).reshape(-1, BUCKETS)
                scr = np.bincount(of_word * N_SCRIPTS + w.script, weights=w.length,
                                  minlength=len(names) * N_SCRIPTS).reshape(-1, N_SCRIPTS)
                for i, name in enumerate(names.tolist()):
                    own = np.concatenate([gram[i], scr[i].astype(np.int64)])
                    held[name] = held[name] + own if name in held else own
        for name, n in held.items():
            at = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(at), pa.string()), pa.array(at.astype(np.int32)),
                                              pa.array(n[at].astype(np.int64))], schema=schema)

    total = base.mapInArrow(count, ddl).groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    # at most BUCKETS + N_SCRIPTS rows a language reach the driver
    names = sorted(r[0] for r in base.select("lang").distinct().limit(MAX_LANGUAGES + 1).collect())
    left_out = 0
    if len(names) > MAX_LANGUAGES:
        total = stored(total, "grams")
        size = total.groupBy("lang").agg(F.sum("n").alias("n"))
        names = sorted(r[0] for r in size.orderBy(F.desc("n"), "lang").limit(MAX_LANGUAGES).collect())
        left_out = base.select("lang").distinct().count() - len(names)
        total = total.join(F.broadcast(base.sparkSession.createDataFrame([(n,) for n in names], "lang string")), "lang", "left_semi")
    got = total.toArrow()
    full = np.zeros((BUCKETS + N_SCRIPTS, len(names)))
    col = {n: i for i, n in enumerate(names)}
    full[got.column("bucket").to_numpy(), [col[x] for x in got.column("lang").to_pylist()]] = got.column("n").to_numpy()
    return Model(names, full[:BUCKETS], full[BUCKETS:], left_out)


def viterbi(score: np.ndarray, first: np.ndarray, switch: float) -> np.ndarray:
    """Best label of each word; score is words x labels, first the word at
    which each text begins.  All texts of a block advance together, the
    longest first, so a step is a few numpy calls."""
    size = np.diff(first)
    order = np.argsort(-size, kind="stable")
    begin, size = first[:-1][order], size[order]
    label = np.zeros(len(score), np.int16)
    back = np.zeros(score.shape, bool)       # the best way to here changes language
    top = np.zeros(len(score), np.int16)     # best label one word before
    active = int((size > 0).sum())
    if not active:
        return label
    cur = score[begin[:active]].astype(np.float64)
    last = np.zeros(active, np.int16)
    live = np.searchsorted(-size, -np.arange(1, size[0] + 1), "right")   # texts with at least t words
    for t in range(1, size[0]):
        n = int(live[t])
        if n < len(cur):
            last[n:len(cur)] = cur[n:].argmax(axis=1)
            cur = cur[:n]
        at = begin[:n] + t
        best = cur.argmax(axis=1)
        jump = cur[np.arange(n), best] - switch
        back[at] = jump[:, None] > cur
        top[at] = best
        cur = np.maximum(cur, jump[:, None]) + score[at]
    last[:len(cur)] = cur.argmax(axis=1)
    for t in range(size[0] - 1, -1, -1):
        n = int(live[t])
        at = begin[:n] + t
        now = last[:n]
        label[at] = now
        if t:
            last[:n] = np.where(back[at, now], top[at], now)
    return label


SPANS = "array<struct<start:int,end:int,lang:string>>"


def identify(docs: DataFrame, model: Model, text: str = "text", switch: float = SWITCH) -> DataFrame:
    """docs with lang_pred, score and spans; columns of these names are replaced.

    lang_pred: the language whose spans hold most letters (ties: first by
    name); ``und`` where the text is null or has no letter, or no language was
    learned.  score: that language's share of the letters times the mean over
    its words of their probability among the candidates (0 for ``und``).
    spans: (start, end, lang) in characters of the text, from the first letter
    of a span's first word to the last letter of its last word.  Each row is judged on
    its own.
    """
    docs = docs.drop("lang_pred", "score", "spans")
    out = docs.withColumn("lang_pred", F.lit("und")).withColumn("score", F.lit(0.0)) \
        .withColumn("spans", F.lit(None).cast(SPANS))
    names = docs.columns
    at = names.index(text)
    sent = docs.sparkSession.sparkContext.broadcast(model)
    span_type = _arrow(f"s {SPANS}").field("s").type

    def task(batches):
        m = sent.value
        for batch in batches:
            for a, b in A.slices(batch.column(at), VITERBI_BYTES):
                part = batch.slice(a, b - a)
                texts = [t or "" for t in part.column(at).cast(pa.string()).to_pylist()]
                words = [_judge(Letters(texts[c:d]), m) for c, d in _blocks(texts)]
                yield pa.RecordBatch.from_arrays(
                    part.columns + _result(words, _blocks(texts), m, switch, span_type, len(texts)),
                    names=[*names, "lang_pred", "score", "spans"])

    return docs.mapInArrow(task, out.schema)


def _judge(w: Letters, m: Model):
    """Words of a block: log-probability by language (words x languages), text,
    letters, first and last character."""
    n = len(w.first)
    if not n or not m.langs:
        return np.zeros((0, len(m.langs)), np.float32), *(np.zeros(0, np.int32) for _ in range(4))
    score = np.add.reduceat(m.score[w.trigrams()], w.first, axis=0)
    score[~m.usable[w.script]] = -1e4
    return score, *(x.astype(np.int32) for x in (w.doc, w.length, w.start, w.start + w.length))


def _result(parts, blocks, m: Model, switch: float, span_type, rows: int) -> list:
    first_text = [a for a, _ in blocks]
    score = np.concatenate([p[0] for p in parts]) if parts else np.zeros((0, len(m.langs)))
    doc = np.concatenate([p[1] + np.int32(a) for p, a in zip(parts, first_text)]) if parts else np.zeros(0, np.int32)
    size, start, end = (np.concatenate([p[i] for p in parts]) if parts else np.zeros(0, np.int64) for i in (2, 3, 4))
    first = np.searchsorted(doc, np.arange(rows + 1))
    label = viterbi(score, first, switch).astype(np.int64)
    k = max(len(m.langs), 1)
    letters = np.bincount(doc * k + label, weights=size, minlength=rows * k).reshape(rows, k)
    total = letters.sum(axis=1)
    best = letters.argmax(axis=1)
    if len(doc):
        top = score.max(axis=1, keepdims=True)
        prob = np.exp(score[np.arange(len(label)), label] - top[:, 0]) / np.exp(score - top).sum(axis=1)
        own = label == best[doc]
        sure = np.bincount(doc[own], weights=prob[own], minlength=rows) / np.maximum(np.bincount(doc[own], minlength=rows), 1)
    else:
        sure = np.zeros(rows)
    value = np.where(total > 0, letters.max(axis=1) / np.maximum(total, 1) * sure, 0.0)
    names = np.array([*m.langs, "und"], object)
    pred = names[np.where(total > 0, best, len(m.langs))]
    edge = np.flatnonzero((np.diff(doc, prepend=-1) != 0) | (np.diff(label, prepend=-1) != 0))
    close = np.append(edge[1:], len(doc)) - 1 if len(doc) else edge
    spans = pa.StructArray.from_arrays(
        [pa.array(start[edge].astype(np.int32)), pa.array(end[close].astype(np.int32)),
         pa.array(names[label[edge]], pa.string())], fields=list(span_type.value_type))
    offsets = np.searchsorted(doc[edge], np.arange(rows + 1)).astype(np.int32)
    return [pa.array(pred, pa.string()), pa.array(np.minimum(value, 1.0)),
            pa.ListArray.from_arrays(pa.array(offsets), spans).cast(span_type)]
