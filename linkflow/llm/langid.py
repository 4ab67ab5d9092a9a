"""Language identification with interpolated Kneser-Ney character models in sorted hash arrays.

Per language, a model of order ``ORDER`` over the letters of padded words is learned from a bounded
sample (``SAMPLE_DOCS`` documents a language, chosen by hash). The n-grams of all languages stand in
one sorted array of 64-bit hashes per order, beside a matrix with one column of log probabilities
per language; a second array holds the contexts' back-off weights. An n-gram's probability in a
language that lacks it is worked out when the table is built, so one search serves all languages.
A text goes to the language with the least cross-entropy per character. The temperature of the
scores and the rejection threshold are calibrated on sample documents kept out of the counts.

Contexts end at the word, so a word's log probabilities are worked out once per worker and summed.
Words start with a letter and hold letters and their marks (Unicode categories L and M), lower-cased;
longer ones are cut at ``LONGEST`` characters.

Defined results: null text, or text without letters (digits, numerals and marks alone are none), is
``und`` with score 0; ties go to the language first in order; repeated rows give repeated results;
if nothing can be learned every text is ``und``; a language with under ``FEW`` rows is learned from
all of them and calibrates nothing; extra columns are not carried.
"""

from __future__ import annotations

import re
import sys
import unicodedata
import uuid
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkflow.llm.common import batch, mix64, trimmed

ORDER = 5
LONGEST = 24
#: Documents a language that the counts are learned from, and that calibrate; expected numbers.
SAMPLE_DOCS, CALIBRATION_DOCS = 1500, 300
#: Rows from which a language gives some away for calibration.
FEW = 10
CACHE_WORDS = 400_000
UNKNOWN = "und"



def _ranges(kind: str) -> str:
    """The characters whose Unicode category starts with a letter of ``kind``, as ranges of a character class."""
    own = groupby(range(sys.maxunicode + 1), lambda i: unicodedata.category(chr(i))[0] in kind)
    found = [(g[0], g[-1]) for yes, g in ((yes, list(g)) for yes, g in own) if yes]
    return "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in found)


_WORD = re.compile(f"[{_ranges('L')}][{_ranges('LM')}]{{0,{LONGEST - 1}}}")
_OUT = pa.schema(
    [("doc_id", pa.int64()), ("held_out", pa.bool_()), ("lang_pred", pa.string()), ("score", pa.float64()), ("cross_entropy", pa.float64()), ("rejected", pa.bool_())]
)
_OUT_DDL = "doc_id long, held_out boolean, lang_pred string, score double, cross_entropy double, rejected boolean"

# The same for texts without characters from U+0300 on, where marks and most scripts begin.
_ASCII, _LATIN, _BEYOND = re.compile("[a-z]{1,%d}" % LONGEST), re.compile(r"[^\W\d_²³¹¼½¾]{1,%d}" % LONGEST), re.compile("[\u0300-\U0010ffff]")


def words(text: str | None) -> list[str]:
    low = text.lower() if text else ""
    if low.isascii():
        return _ASCII.findall(low)
    return (_WORD if _BEYOND.search(low) else _LATIN).findall(low)


def _grams(vocabulary: list[str], order: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the 1..order-grams that end at each predicted character, and each one's word.

    Row n of the first array holds n-grams, row n of the second their contexts (n - 1 characters).
    """
    size = np.fromiter(map(len, vocabulary), np.int64, len(vocabulary)) + order
    pad = "\x02" * (order - 1)
    flat = np.frombuffer("".join(f"{pad}{w}\x03" for w in vocabulary).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    which = np.repeat(np.arange(len(vocabulary)), size)
    off = np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)
    at = np.flatnonzero(off >= order - 1)
    gram, context = (np.zeros((order + 1, len(at)), np.uint64) for _ in range(2))
    # Hashes are built from the nearest character backwards; the last character goes in at the end.
    h = np.zeros(len(at), np.uint64)
    for n in range(1, order + 1):
        if n > 1:
            h = mix64(h ^ (flat[at - n + 1] + np.uint64(n << 32)))
        context[n] = h
        gram[n] = mix64(h + mix64(flat[at] + np.uint64(7 << 40)))
    return gram, context, which[at]


def learn(vocabulary: list[str], counts: np.ndarray, order: int = ORDER) -> list[dict[str, np.ndarray]]:
    """One language: per order the n-grams' log10 probabilities and the contexts' log10 back-off weights."""
    gram, context, which = _grams(vocabulary, order)
    out: list[dict[str, np.ndarray]] = [{} for _ in range(order + 1)]
    count = np.zeros(0)
    levels = []
    upper: np.ndarray | None = None
    for n in range(order, 0, -1):
        g, first, inverse = np.unique(gram[n], return_index=True, return_inverse=True)
        if upper is None:
            count = np.bincount(inverse, counts[which], len(g))
        else:
            # Continuation count: the number of distinct longer n-grams that end in this one.
            count = np.bincount(inverse[upper], minlength=len(g)).astype(float)
        upper = first
        levels.append((n, g, first, count))
    below = np.full(1, 1.0 / (len(levels[-1][1]) + 1))
    for n, g, first, count in reversed(levels):
        c, node = np.unique(context[n][first], return_inverse=True)
        total, kinds = np.bincount(node, count), np.bincount(node)
        n1, n2 = (count == 1).sum(), (count == 2).sum()
        discount = min(max(n1 / (n1 + 2 * n2), 0.1), 0.95) if n1 + n2 else 0.5
        weight = discount * kinds / total
        lower = below[0] if n == 1 else below[np.searchsorted(out[n - 1]["gram"], gram[n - 1][first])]
        p = np.maximum(count - discount, 0) / total[node] + weight[node] * lower
        out[n] = {"gram": g, "p": np.log10(p), "context": c, "w": np.log10(weight)}
        below = p
    out[0] = {"p": np.log10(np.full(1, 1.0 / (len(out[1]["gram"]) + 1)))}
    return out


class Model:
    """All languages' models in shared sorted arrays."""

    def __init__(self, models: dict[str, list[dict[str, np.ndarray]]], grams: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]], order: int = ORDER):
        self.languages, self.order = sorted(models), order
        self.uid = uuid.uuid4().hex
        self.temperature, self.reject = 1.0, np.full(len(models), np.inf)
        k = len(models)
        self.floor = np.array([models[x][0]["p"][0] for x in self.languages], np.float32)
        self.gram, self.p, self.context, self.w = ([np.zeros(0)] * (order + 1) for _ in range(4))
        for n in range(1, order + 1):
            key, context, suffix = grams[n]
            self.context[n] = np.unique(np.concatenate([models[x][n]["context"] for x in self.languages]))
            self.w[n] = np.zeros((len(self.context[n]), k), np.float32)
            for j, x in enumerate(self.languages):
                self.w[n][np.searchsorted(self.context[n], models[x][n]["context"]), j] = models[x][n]["w"]
            self.gram[n] = key
            # Backed off everywhere, then the languages' own values over it.
            lower = np.broadcast_to(self.floor, (len(key), k)) if n == 1 else self.p[n - 1][np.searchsorted(self.gram[n - 1], suffix)]
            self.p[n] = lower + self.w[n][np.searchsorted(self.context[n], context)]
            for j, x in enumerate(self.languages):
                self.p[n][np.searchsorted(key, models[x][n]["gram"]), j] = models[x][n]["p"]

    def score(self, vocabulary: list[str]) -> np.ndarray:
        """log10 probabilities of each word (with its end), one column a language."""
        gram, context, which = _grams(vocabulary, self.order)
        got = np.zeros((len(which), len(self.languages)), np.float32)
        left = np.arange(len(which))
        for n in range(self.order, 0, -1):
            key = gram[n][left]
            at = np.minimum(np.searchsorted(self.gram[n], key), len(self.gram[n]) - 1)
            hit = self.gram[n][at] == key
            got[left[hit]] += self.p[n][at[hit]]
            left = left[~hit]
            key = context[n][left]
            at = np.minimum(np.searchsorted(self.context[n], key), len(self.context[n]) - 1)
            some = self.context[n][at] == key
            got[left[some]] += self.w[n][at[some]]
        got[left] += self.floor
        out = np.zeros((len(vocabulary), len(self.languages)))
        np.add.at(out, which, got)
        return out


class Scorer:
    """Sums words' log probabilities; remembers up to ``CACHE_WORDS`` words."""

    def __init__(self, model: Model):
        self.model, self.at = model, {}
        self.rows = np.zeros((CACHE_WORDS, len(model.languages)), np.float32)

    def _learn(self, new: list[str]) -> None:
        for i in range(0, len(new), 8192):
            part = new[i : i + 8192]
            first = len(self.at)
            self.rows[first : first + len(part)] = self.model.score(part)
            self.at.update(zip(part, range(first, first + len(part)), strict=True))

    def entropies(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Characters (with word ends), and cross-entropy per character and language, of each text."""
        split = [words(t) for t in texts]
        n, out = np.zeros(len(texts), np.int64), np.zeros((len(texts), len(self.model.languages)))
        for k, w in enumerate(split):
            if not w:
                continue
            new = {x for x in w if x not in self.at}
            if len(self.at) + len(new) > CACHE_WORDS:
                self.at.clear()
                new = set(w)
            if len(new) > CACHE_WORDS:
                # A text with more distinct words than the cache holds is summed in parts.
                total = np.zeros(out.shape[1])
                for i in range(0, len(w), 8192):
                    total += self.model.score(w[i : i + 8192]).sum(0)
            else:
                self._learn(list(new))
                total = self.rows[np.fromiter(map(self.at.__getitem__, w), np.int64, len(w))].sum(0, dtype=float)
            n[k] = sum(map(len, w)) + len(w)
            out[k] = -total / n[k]
        return n, out


def _draw(wanted: int, counts: dict[str, int], low: Column) -> Column:
    """Rows whose hash falls into the language's share, from ``low`` expected documents on."""
    u = F.pmod(F.xxhash64("doc_id", "text", F.lit("langid")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    per = _by_language({k: float(n) for k, n in counts.items()})
    return (u * per >= low) & (u * per < low + wanted)


def _by_language(values: dict[str, float]) -> Column:
    return F.create_map(*[F.lit(x) for item in values.items() for x in item])[F.col("lang")]


def fit(docs: DataFrame, order: int = ORDER, sample_docs: int = SAMPLE_DOCS, calibration_docs: int = CALIBRATION_DOCS) -> Model | None:
    """Learns from ``docs(doc_id, text, lang)``, the rows that may be learned from.

    The model has a column for each language, and one task learns a language from its bounded sample.
    """
    docs = docs.where("lang is not null and text is not null")
    counts = {r.lang: r.n for r in docs.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return None
    # The first rows of a language calibrate, so no row is counted from that the thresholds come from.
    kept = {k: 0.0 if n < FEW else float(min(calibration_docs, n / 5)) for k, n in counts.items()}
    start = _by_language(kept)
    train = docs.where(_draw(sample_docs, counts, start))

    def tally(batches):
        from collections import Counter

        found: dict[str, Counter] = {}
        for b in batches:
            for t, lang in zip(b.column(0), b.column(1), strict=True):
                found.setdefault(lang.as_py(), Counter()).update(words(t.as_py()))
        for lang, c in found.items():
            yield pa.RecordBatch.from_pydict(
                {"lang": [lang] * len(c), "word": list(c), "n": list(c.values())},
                pa.schema([("lang", pa.string()), ("word", pa.string()), ("n", pa.int64())])
            )

    vocabulary = train.select("text", "lang").mapInArrow(tally, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))

    def build(key, t):
        import pickle

        got = learn(t.column("word").to_pylist(), t.column("n").to_numpy().astype(float), order)
        gram, context, _ = _grams(t.column("word").to_pylist(), order)
        for n in range(1, order + 1):
            _, first = np.unique(gram[n], return_index=True)
            got[n]["of"], got[n]["suffix"] = context[n][first], gram[n - 1][first]
        return pa.table({"lang": [key[0].as_py()], "model": [pickle.dumps(got)]})

    import pickle

    models = {r.lang: pickle.loads(r.model) for r in vocabulary.groupBy("lang").applyInArrow(build, "lang string, model binary").collect()}
    if not models:
        return None
    grams = {}
    for n in range(1, order + 1):
        key, first = np.unique(np.concatenate([m[n]["gram"] for m in models.values()]), return_index=True)
        grams[n] = (key, *(np.concatenate([m[n][x] for m in models.values()])[first] for x in ("of", "suffix")))
    model = Model(models, grams, order)
    calibration = docs.where(_draw(calibration_docs, counts, F.lit(0.0)) & ~_draw(sample_docs, counts, start))
    rows = [
        (r.lang, np.array(r.h)) for r in _entropies(calibration.select(F.lit(0).cast("long").alias("doc_id"), F.lit(False).alias("held_out"), "text", "lang"), model).collect() if r.n and r.lang in models
    ]
    if rows:
        truth, h = np.array([model.languages.index(x) for x, _ in rows]), np.stack([x for _, x in rows])
        grid = np.geomspace(1, 300, 40)
        lost = []
        for t in grid:
            z = -h * t
            z -= z.max(1, keepdims=True)
            lost.append(-(z[np.arange(len(z)), truth] - np.log(np.exp(z).sum(1))).mean())
        model.temperature = float(grid[int(np.argmin(lost))])
        for j in range(len(model.languages)):
            own = h[truth == j, j]
            if len(own) >= 5:
                # Above the 99th percentile by three interquartile ranges, a text is like no sample.
                q1, q3, top = np.percentile(own, [25, 75, 99])
                model.reject[j] = top + 3 * (q3 - q1) + 1e-6
    return model


def _entropies(docs: DataFrame, model: Model) -> DataFrame:
    """Per row of ``docs(doc_id, held_out, text, lang)`` the characters and cross-entropies."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        s = Scorer(shared.value)
        for b in batches:
            n, h = s.entropies(b.column(2).to_pylist())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(3), pa.array(n), pa.array(list(h), pa.list_(pa.float64()))], names=["doc_id", "lang", "n", "h"])

    return docs.select("doc_id", "held_out", "text", "lang").mapInArrow(trimmed(run), "doc_id long, lang string, n long, h array<double>")


_SCORERS: dict[str, Scorer] = {}


def predict(docs: DataFrame, model: Model | None, held_out: Column, reject: bool = False) -> DataFrame:
    """The language of each text. With ``reject``, texts over the calibrated threshold are ``und``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        model = shared.value
        if model is not None and model.uid not in _SCORERS:
            _SCORERS.clear()
            _SCORERS[model.uid] = Scorer(model)
        for b in batches:
            for i in range(0, b.num_rows, 256):
                p = b.slice(i, 256)
                pred, score, least, rejected = ([UNKNOWN] * p.num_rows, np.zeros(p.num_rows), [None] * p.num_rows, [False] * p.num_rows)
                if model is not None:
                    n, h = _SCORERS[model.uid].entropies(p.column(2).to_pylist())
                    z = -h * model.temperature
                    z = np.exp(z - z.max(1, keepdims=True))
                    best, sure = h.argmin(1), z.max(1) / z.sum(1)
                    for k in np.flatnonzero(n).tolist():
                        rejected[k] = bool(h[k, best[k]] > model.reject[best[k]])
                        least[k] = float(h[k, best[k]])
                        if not (reject and rejected[k]):
                            pred[k], score[k] = model.languages[best[k]], sure[k]
                yield batch(_OUT, p.column(0), p.column(1), pred, score, least, rejected)

    return docs.select(F.col("doc_id").cast("long"), held_out.alias("held_out"), "text").mapInArrow(trimmed(run), _OUT_DDL)
