"""Toxicity by subword-bag embeddings and a linear softmax, trained jointly in numpy.

A word's vector is the mean of the vectors of its character n-grams (3 to 5
characters of "<word>") and of the whole word, all in one hashed table. A run of
`segment` words, from any word on, is the mean of its words (a shorter text is one
run), and a linear softmax over that mean
gives the chance of label 1. A document scores as its worst run, so a few bad
words count in a text of any length. Table and softmax are trained together by
gradient steps, first on means of whole texts and then on the worst run of each
(for label 0 also on a random one), chosen anew every few steps.

The model is fitted on a bounded sample: at most `per_class` rows of each label
whose text has at most `longest` characters, taken in the order of a hash of
their number. Every whole text is scored. As the mean is linear, a word adds one
number to its run; tasks keep those numbers in a bounded cache.

Null and empty texts score as no words at all: the softmax's bias alone. Without
training rows of both labels the score is the share of label 1 among them (0
without any). Rows with equal or null doc_id are scored each for itself. Columns
other than doc_id and text are not read; labels of null are not learned from.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from altigrid.llm.common import hold, small_batches, wider

WORD = re.compile(r"[^\W_]+(?:['’*@$!0-9_-]+[^\W_]+)*")
ROWS = 1 << 16


def grams(word: str) -> list[int]:
    """Table rows of a word: its n-grams of 3 to 5 characters and the word itself."""
    framed = f"<{word}>"
    n = len(framed)
    parts = [framed[i:i + k] for k in (3, 4, 5) for i in range(n - k + 1)]
    return [zlib.crc32(p.encode("utf-8", "surrogatepass")) % ROWS for p in (*parts, framed)]


def words_of(text: str | None) -> list[str]:
    return WORD.findall((text or "").lower())


@dataclass
class Model:
    """Contribution of each table row to the logit, and the bias."""

    weight: np.ndarray
    bias: float
    segment: int

    def __post_init__(self):
        self.cache: dict[str, float] = {}

    def value(self, word: str) -> float:
        found = self.cache.get(word)
        if found is None:
            if len(self.cache) >= 200_000:
                self.cache.clear()
            found = self.cache[word] = float(self.weight[grams(word)].mean())
        return found

    def score(self, text: str | None) -> float:
        words = words_of(text)
        worst = 0.0
        if words:
            values = np.fromiter(map(self.value, words), np.float64, len(words))
            span, sums = min(self.segment, len(values)), np.concatenate([[0.0], np.cumsum(values)])
            worst = float((sums[span:] - sums[:-span]).max() / span)
        return float(1 / (1 + np.exp(-np.clip(worst + self.bias, -60, 60))))

    def __getstate__(self):
        return {"weight": self.weight, "bias": self.bias, "segment": self.segment}

    def __setstate__(self, state):
        self.__dict__.update(state, cache={})


def fit(
    texts: list[str], labels: list[int], segment: int = 4, size: int = 16, warm: int = 40, steps: int = 200,
    rate: float = 4.0, prior: float = 0.5, decay: float = 1e-4,
) -> Model:
    """Train the table and the softmax on whole texts, by full-batch gradient steps.

    `warm` steps average each whole text; the others average single runs: the
    worst of each text and one random run of each text of label 0. With two classes
    all rows move along one direction, the difference of the class vectors, so
    a step needs one number per word. Rare rows move less: a row's step is
    divided by the root of its mass in the sample plus `prior`.
    """
    y = np.array(labels, np.int64)
    if len(y) == 0 or y.min() == y.max():
        share = float(y.mean()) if len(y) else 0.0
        return Model(np.zeros(ROWS, np.float32), float(np.log((share + 1e-26) / (1 - share + 1e-26))), segment)
    rng = np.random.default_rng(7)
    index: dict[str, int] = {}
    held, ends = array("i"), []
    for t in texts:
        held.extend(index.setdefault(w, len(index)) for w in words_of(t) or [""])
        ends.append(len(held))
    words, length = np.frombuffer(held, np.int32), np.diff([0, *ends])
    rows, ends = array("i"), []
    for w in index:
        rows.extend(grams(w))
        ends.append(len(rows))
    n_words = len(index)
    index.clear()
    flat, sizes = np.frombuffer(rows, np.int32), np.diff([0, *ends])
    first, word_of = np.cumsum(sizes) - sizes, np.repeat(np.arange(n_words, dtype=np.int32), sizes)
    begin = np.concatenate([[0], np.cumsum(length)[:-1]])
    runs = np.maximum(length - segment + 1, 1)
    run_doc = np.repeat(np.arange(len(y), dtype=np.int32), runs)
    run_first = np.cumsum(runs) - runs
    run_begin = np.arange(runs.sum()) + (begin - run_first)[run_doc]
    run_length = np.minimum(segment, length)[run_doc]

    def spread(per_word: np.ndarray) -> np.ndarray:
        return np.bincount(flat, (per_word / sizes)[word_of], ROWS)

    table = rng.normal(0, 0.01, (ROWS, size))
    soft, bias = np.stack([np.full(size, -1.0), np.full(size, 1.0)]) / size**0.5, np.zeros(2)
    balance = np.where(y == 1, 0.5 / y.mean(), 0.5 / (1 - y.mean())) / len(y)
    mass = spread(np.bincount(words, minlength=n_words))
    slow = np.sqrt(mass / mass.mean() + prior)
    doc_picks = begin, length, np.arange(len(y))
    for step in range(warm + steps):
        lean = table @ (soft[1] - soft[0])
        value = np.add.reduceat(lean[flat], first) / sizes
        if step < warm:
            at, span, owner = doc_picks
        elif (step - warm) % 4 == 0:
            sums = np.concatenate([[0.0], np.cumsum(value[words])])
            means = (sums[run_begin + run_length] - sums[run_begin]) / run_length
            top = np.flatnonzero(means == np.maximum.reduceat(means, run_first)[run_doc])
            worst = top[np.flatnonzero(np.diff(run_doc[top], prepend=-1))]
            clean = np.flatnonzero(y == 0)
            drawn = run_first[clean] + rng.integers(0, runs[clean])
            picked = np.concatenate([worst, drawn])
            at, span, owner = run_begin[picked], run_length[picked], run_doc[picked]
        inside = np.repeat(at - (np.cumsum(span) - span), span) + np.arange(span.sum())
        mean = np.add.reduceat(value[words[inside]], np.cumsum(span) - span) / span
        error = (1 / (1 + np.exp(-np.clip(mean + bias[1] - bias[0], -60, 60))) - y[owner]) * balance[owner]
        per_row = spread(np.bincount(words[inside], np.repeat(error / span, span), n_words))
        pull = table.T @ per_row
        table -= rate * (len(y) / slow * per_row)[:, None] * (soft[1] - soft[0])[None, :] + decay * table
        soft += 0.1 * np.stack([pull, -pull])
        bias += 0.1 * np.array([error.sum(), -error.sum()])
    return Model((table @ (soft[1] - soft[0])).astype(np.float32), float(bias[1] - bias[0]), segment)


def held_out(doc_id: Column) -> Column:
    """Whether a document's labels are kept for checking: crc32 of its number modulo 5 is 0."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame, per_class: int, longest: int) -> list:
    """The bounded sample: (text, toxic) rows, at most per_class of each label."""
    marks = labels.where("doc_id IS NOT NULL AND toxic IN (0, 1)").where(~held_out(F.col("doc_id")))
    marks = marks.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    able = docs.where("doc_id IS NOT NULL").where(F.coalesce(F.length("text"), F.lit(0)) <= longest)
    ids = able.select("doc_id").join(marks, "doc_id").select("doc_id", "toxic", F.xxhash64("doc_id").alias("draw")).distinct()
    taken = ids.where("toxic = 1").orderBy("draw").limit(per_class).unionByName(ids.where("toxic = 0").orderBy("draw").limit(per_class))
    return able.join(F.broadcast(taken), "doc_id").select("doc_id", "text", "toxic").dropDuplicates(["doc_id"]).collect()


def train(docs: DataFrame, labels: DataFrame, per_class: int = 2000, longest: int = 20_000) -> Model:
    rows = sorted(training_rows(docs.select("doc_id", "text"), labels.select("doc_id", "toxic"), per_class, longest), key=lambda r: r.doc_id)
    return fit([r.text for r in rows], [r.toxic for r in rows])


def score(docs: DataFrame, model: Model, column: str = "score") -> DataFrame:
    """All columns of docs and the score of their whole text."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    out = wider(docs, {column: "double"})

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ready = sent.value
        hold("toxicity", ready.cache.clear)
        for batch in small_batches(batches, "text"):
            scores = pa.array([ready.score(t) for t in batch.column("text").to_pylist()], pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns, scores], names=[*batch.schema.names, column])

    return docs.mapInArrow(read, out)


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted for every row of docs."""
    model = train(docs, labels)
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ready = sent.value
        hold("toxicity", ready.cache.clear)
        for batch in small_batches(batches, "text"):
            scores = pa.array([ready.score(t) for t in batch.column("text").to_pylist()], pa.float64())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), scores], names=["doc_id", "score"])

    scored = docs.select("doc_id", "text").mapInArrow(read, "doc_id long, score double")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of docs that the model does not reject."""
    return score(docs, train(docs, labels), "_toxic_score").where("_toxic_score < 0.5").drop("_toxic_score")
