"""Language identification by word-first backoff.

A word (a run of letters, lower-cased) that the model knows is scored by its
per-language log frequency.  An unseen word falls back to its character
4-grams, then 3-, 2- and 1-grams: the longest length of which at least one gram
is known scores the word with the mean of its known grams.  A text's score adds
its words' log posteriors under equal priors.

The classifier is fitted on a bounded sample of labelled rows: about
``max_docs`` documents of each language, drawn by a hash of doc_id and text, so
a rare language is learned from as many rows as a frequent one.  The
``max_words`` words and ``max_grams`` grams per length that are most frequent
within some language are kept.  These bounds make the model a broadcast of fixed
size per language; prediction reads every whole text.

Defined cases: null text or text without a letter is ``und`` with score 0; ties
go to the first language in code-point order; with no labelled rows every text
is ``und``; rows with null lang or null text are not learned from.
"""

from __future__ import annotations

import sys
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexis.llm.words import SLICE_BYTES, U64, column, mix
from lexis.session import materialize

LONGEST = 4
_BASE = 0x9E3779B97F4A7C15 | 1


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.array([unicodedata.category(chr(c))[0] == "L" for c in range(sys.maxunicode + 1)])


class LetterWords:
    """Letter words of lower-cased texts: code points, with one blank around
    every run, hashes, and the document of each word."""

    def __init__(self, texts: list[str]):
        lowered = [f" {t.lower()} " for t in texts]
        points = np.frombuffer("".join(lowered).encode("utf-32-le", "surrogatepass"), np.uint32)
        letter = _letters()[points]
        self.points = np.where(letter, points, 32).astype(np.uint64)
        self.starts = np.flatnonzero(letter & ~np.append(False, letter[:-1]))
        self.sizes = np.flatnonzero(letter & ~np.append(letter[1:], False)) + 1 - self.starts
        bounds = np.cumsum([0] + [len(t) for t in lowered])
        self.doc = np.searchsorted(bounds, self.starts, "right") - 1
        self.hash = self._sums(self.starts, self.sizes)

    def _sums(self, starts, sizes) -> np.ndarray:
        if not len(starts):
            return np.empty(0, np.uint64)
        begin = np.cumsum(sizes) - sizes
        within = np.arange(int(sizes.sum())) - np.repeat(begin, sizes)
        power = np.cumprod(np.append(U64(1), np.full(int(sizes.max()) - 1, _BASE, np.uint64)))
        return mix(np.add.reduceat(mix(self.points[within + np.repeat(starts, sizes)]) * power[within], begin)
                   + sizes.astype(np.uint64))

    def grams(self, which: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of the n-grams of the chosen words (with one blank on either
        side for n > 1) and the position in ``which`` each belongs to."""
        pad = 1 if n > 1 else 0
        runs = np.maximum(self.sizes[which] + 2 * pad - n + 1, 0)
        owner = np.repeat(np.arange(len(which)), runs)
        at = np.arange(len(owner)) - (np.cumsum(runs) - runs)[owner] + self.starts[which][owner] - pad
        total = np.full(len(at), n, np.uint64)
        for j in range(n):
            total = mix(total * U64(_BASE) + self.points[at + j])
        return total, owner


def _slices(texts: pa.Array):
    a, size, held = 0, 0, []
    for i, value in enumerate(texts):
        text = value.as_py() or ""
        held.append(text)
        size += len(text)
        if size >= SLICE_BYTES:
            yield a, i + 1, LetterWords(held)
            a, size, held = i + 1, 0, []
    if held:
        yield a, len(texts), LetterWords(held)


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, kind, name, n): words (kind 0) and n-grams (kind n) of labelled texts."""
    for batch in batches:
        langs = column(batch, "lang").to_pylist()
        for a, _, words in _slices(column(batch, "text")):
            for lang in sorted({langs[a + d] for d in np.unique(words.doc)}):
                mine = np.flatnonzero(np.array([x == lang for x in langs[a:]])[words.doc])
                for kind in range(LONGEST + 1):
                    names = words.hash[mine] if kind == 0 else words.grams(mine, kind)[0]
                    name, n = np.unique(names, return_counts=True)
                    yield pa.record_batch({"lang": pa.array([lang] * len(name), pa.string()), "kind": pa.array([kind] * len(name), pa.int32()),
                                           "name": pa.array(name.view(np.int64)), "n": pa.array(n, pa.int64())})


class Model:
    """Per kind: sorted names and their log frequencies per language."""

    def __init__(self, langs: list[str], names: list[np.ndarray], logs: list[np.ndarray]):
        self.langs, self.names, self.logs = langs, names, logs

    def known(self, kind: int, values: np.ndarray) -> np.ndarray:
        """Row of each value in the tables of ``kind``, or -1."""
        names = self.names[kind]
        if not len(names):
            return np.full(len(values), -1)
        spot = np.minimum(np.searchsorted(names, values), len(names) - 1)
        return np.where(names[spot] == values, spot, -1)

    def word_scores(self, words: LetterWords, which: np.ndarray) -> np.ndarray:
        """Log posterior (equal priors) of every language for the chosen words."""
        out = np.zeros((len(which), len(self.langs)))
        row = self.known(0, words.hash[which])
        out[row >= 0] = self.logs[0][row[row >= 0]]
        left = np.flatnonzero(row < 0)
        for kind in range(LONGEST, 0, -1):
            if not len(left):
                break
            grams, owner = words.grams(which[left], kind)
            row = self.known(kind, grams)
            hit = np.flatnonzero(row >= 0)
            number = np.bincount(owner[hit], minlength=len(left))
            for k in range(len(self.langs)):
                total = np.bincount(owner[hit], weights=self.logs[kind][row[hit], k], minlength=len(left))
                out[left[number > 0], k] = total[number > 0] / number[number > 0]
            left = left[number == 0]
        top = out.max(axis=1, keepdims=True)
        return out - top - np.log(np.exp(out - top).sum(axis=1, keepdims=True))


def sample_share(count: int, max_docs: int) -> float:
    """The part of a language's rows that is learned from; above 0 at any count."""
    return min(1.0, max_docs / max(count, 1))


def fit(labelled: DataFrame, max_docs: int = 3_000, max_words: int = 200_000, max_grams: int = 100_000) -> Model:
    """Fits on a sample of about ``max_docs`` rows of each language of ``labelled(doc_id, text, lang)``."""
    rows = labelled.select("doc_id", "text", "lang").filter("text is not null and lang is not null")
    held = dict(rows.groupBy("lang").count().collect())  # one row per language
    langs = sorted(held)
    code = F.array_position(F.array(*[F.lit(x) for x in langs]), F.col("lang")).cast("int") - 1 if langs else F.lit(0)
    share = F.get(F.array(*[F.lit(sample_share(held[x], max_docs)) for x in langs]), code) if langs else F.lit(0.0)
    draw = F.shiftrightunsigned(F.xxhash64("doc_id", "text"), 11) / F.lit(float(1 << 53))
    counts = materialize(rows.filter(draw < share).mapInArrow(_counts, "lang string, kind int, name long, n long")
                         .withColumn("code", code).groupBy("code", "kind", "name").agg(F.sum("n").alias("n")), "language-counts")
    columns = [str(i) for i in range(len(langs))]
    names, logs = [], []
    for kind in range(LONGEST + 1):
        if not langs:
            names.append(np.empty(0, np.uint64))
            logs.append(np.empty((0, 0)))
            continue
        mine = counts.filter(F.col("kind") == kind)
        totals = dict(mine.groupBy("code").agg(F.sum("n")).collect())
        size = np.array([totals.get(i, 0) for i in range(len(langs))], np.float64)
        table = mine.groupBy("name").pivot("code", list(range(len(langs)))).agg(F.sum("n")).na.fill(0)
        often = F.array_max(F.array(*[F.col(c) / F.lit(max(float(n), 1.0)) for c, n in zip(columns, size)]))
        top = table.orderBy(often.desc(), "name").limit(max_words if kind == 0 else max_grams).toPandas()
        name = top["name"].to_numpy(np.int64).view(np.uint64)
        n = top[columns].to_numpy(np.float64)
        order = np.argsort(name)
        names.append(name[order])
        logs.append(np.log((n[order] + 0.1) / (size + 0.1 * (len(name) + 1))))
    return Model(langs, names, logs)


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """Every row of ``docs(text, ...)`` without its text, with ``lang_pred`` and
    ``score``, the posterior of the predicted language."""
    names = [c for c in docs.columns if c not in ("text", "lang_pred", "score")]
    schema = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in docs.select(*names).schema.fields) + "lang_pred string, score double"
    shared = docs.sparkSession.sparkContext.broadcast(model)  # size bounded by max_words and max_grams

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            for a, b, words in _slices(column(batch, "text")):
                total = np.zeros((b - a, max(len(model.langs), 1)))
                if len(words.hash) and model.langs:
                    _, which, back = np.unique(words.hash, return_index=True, return_inverse=True)
                    scores = model.word_scores(words, which)
                    for k in range(len(model.langs)):
                        total[:, k] = np.bincount(words.doc, weights=scores[back, k], minlength=b - a)
                some = np.bincount(words.doc, minlength=b - a)[:b - a] > 0
                best = total.argmax(axis=1)
                sure = 1.0 / np.exp(np.maximum(total - total.max(axis=1, keepdims=True), -700)).sum(axis=1)
                ok = some & bool(model.langs)
                yield pa.record_batch([*(column(batch, n).slice(a, b - a) for n in names),
                                       pa.array([model.langs[k] if x else "und" for k, x in zip(best, ok)], pa.string()),
                                       pa.array(np.where(ok, sure, 0.0))], names=[*names, "lang_pred", "score"])

    return docs.select("text", *names).mapInArrow(run, schema)
