"""Language identification: sparse multinomial logistic regression on TF-IDF
character n-grams, trained by FTRL with elastic-net penalties, followed by
temperature calibration.

Features are the 1- to 3-grams of the lower-cased letters (a run of other
characters is one space), hashed to ``DIM`` buckets; a document's vector is
tf * idf, scaled to length 1.  The model is fitted on a bounded sample:
``per_class`` documents a language (default ``PER_CLASS``), whole texts, of
which one in five only sets the temperature.  The sample's vectors meet in
one task; the model (``DIM`` x languages floats) goes to every worker.  All
documents are scored, whole, in one map-only pass.

Defined cases: a text that is null or has no letter gets ``und`` with score
0; without any labelled document every text gets ``und``; a null id is never
learned from and is not held out; repeated rows get equal predictions; extra
columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from metroflux.llm.linear import Ftrl, fold, sample_classes, softmax, unit

DIM_BITS = 15
DIM = 1 << DIM_BITS
PER_CLASS = 1500
EPOCHS = 3
_LETTER: list[np.ndarray] = []


def letters() -> np.ndarray:
    """Whether each code point is a letter."""
    if not _LETTER:
        _LETTER.append(np.fromiter((chr(i).isalpha() for i in range(0x110000)), dtype=bool, count=0x110000))
    return _LETTER[0]


def gram_counts(text: str) -> np.ndarray | None:
    """Counts of the text's n-grams by bucket; None without letters."""
    code = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    letter = letters()[code]
    if not letter.any():
        return None
    first = np.empty_like(letter)
    first[0] = False
    first[1:] = letter[:-1]
    kept = letter | first  # of a run of other characters, the first
    c = np.where(letter, code, 32)[kept].astype(np.uint64)
    if c[-1] != 32:
        c = np.append(c, np.uint64(32))
    c = np.concatenate([np.array([32], dtype=np.uint64), c])
    two = c[:-1] << np.uint64(21) | c[1:]
    three = two[:-1] << np.uint64(21) | c[2:]
    keys = np.concatenate([c, two | np.uint64(1 << 42), three])
    return np.bincount(((keys * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - DIM_BITS)).astype(np.int64), minlength=DIM)


@dataclass
class Model:
    languages: list[str]
    idf: np.ndarray
    weights: np.ndarray  # (DIM, languages)
    temperature: float

    def predict(self, text: str | None) -> tuple[str, float]:
        counts = gram_counts(text) if text and self.languages else None
        if counts is None:
            return "und", 0.0
        x = counts * self.idf
        logits = (x @ self.weights) / max(float(np.sqrt(x @ x)), 1e-9)
        p = softmax(logits.astype(np.float64) / self.temperature)
        best = int(p.argmax())
        return self.languages[best], float(p[best])


def fit(rows: list[tuple[str, bool, np.ndarray, np.ndarray]]) -> Model:
    """Train on (language, calibrate, buckets, counts) rows."""
    languages = sorted({r[0] for r in rows})
    number = {name: i for i, name in enumerate(languages)}
    df = np.zeros(DIM)
    for _, _, idx, _ in rows:
        df[idx] += 1
    idf = (np.log((1 + len(rows)) / (1 + df)) + 1).astype(np.float32)

    def vector(idx, counts):
        x = counts * idf[idx]
        return x / np.sqrt(x @ x)

    data = [(number[lang], cal, idx, vector(idx, counts)) for lang, cal, idx, counts in rows]
    model = Ftrl(DIM, len(languages), alpha=1.0, l1=0.02, l2=0.01)
    train = [d for d in data if not d[1]] or data
    shuffled = np.random.default_rng(0)
    for _ in range(EPOCHS):
        for i in shuffled.permutation(len(train)):
            y, _, idx, x = train[i]
            w = model.weights(idx)
            p = softmax(x @ w)
            p[y] -= 1
            model.update(idx, w, x[:, None] * p)
    weights = model.weights().astype(np.float32)
    held = [(y, x @ weights[idx]) for y, cal, idx, x in data if cal]
    return Model(languages, idf, weights, temperature([h[0] for h in held], np.array([h[1] for h in held])) if held else 1.0)


def temperature(y: list[int], logits: np.ndarray) -> float:
    """The temperature with the least log loss (golden-section search over
    its logarithm)."""
    def loss(t: float) -> float:
        p = softmax(logits / np.exp(t))
        return -float(np.log(np.maximum(p[np.arange(len(y)), y], 1e-12)).mean())

    lo, hi, g = np.log(0.05), np.log(20.0), (np.sqrt(5) - 1) / 2
    for _ in range(40):
        a, b = hi - g * (hi - lo), lo + g * (hi - lo)
        lo, hi = (lo, b) if loss(a) <= loss(b) else (a, hi)
    return float(np.exp((lo + hi) / 2))


def train(docs: DataFrame, learn: Column, text_col: str = "text", lang_col: str = "lang", per_class: int = PER_CLASS) -> Model:
    """Fit on a sample of the rows of ``docs`` for which ``learn`` holds."""
    rows = docs.where(learn & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(
        F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text"))
    sample = sample_classes(rows, "lang", per_class, ["text"]).withColumn("calibrate", unit(F.lit("calibrate"), F.col("text")) < 0.2)

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = [[], [], [], []]
            for lang, text, cal in zip(*(b.column(i).to_pylist() for i in range(3)), strict=True):
                counts = gram_counts(text)
                if counts is not None:
                    idx = np.flatnonzero(counts)
                    for to, x in zip(out, (lang, cal, idx.astype(np.int32).tobytes(), counts[idx].astype(np.float32).tobytes()), strict=True):
                        to.append(x)
            yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.string()), pa.array(out[1], pa.bool_()), pa.array(out[2], pa.binary()), pa.array(out[3], pa.binary())],
                                             ["lang", "calibrate", "idx", "counts"])

    def fit_one(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [(r["lang"], r["calibrate"], np.frombuffer(r["idx"], np.int32), np.frombuffer(r["counts"], np.float32))
                for b in batches for r in b.to_pylist()]
        rows.sort(key=lambda r: (r[0], len(r[2]), r[2].tobytes(), r[3].tobytes()))  # the same model however rows arrive
        if rows:
            m = fit(rows)
            yield pa.RecordBatch.from_arrays([pa.array([m.languages], pa.list_(pa.string())), pa.array([m.idf.tobytes()], pa.binary()),
                                              pa.array([m.weights.tobytes()], pa.binary()), pa.array([m.temperature])],
                                             ["languages", "idf", "weights", "temperature"])

    got = (sample.select("lang", "text", "calibrate").mapInArrow(vectors, "lang string, calibrate boolean, idx binary, counts binary")
           .repartition(1).mapInArrow(fit_one, "languages array<string>, idf binary, weights binary, temperature double").collect())
    if not got:
        return Model([], np.zeros(DIM, np.float32), np.zeros((DIM, 0), np.float32), 1.0)
    m = got[0]
    return Model(list(m.languages), np.frombuffer(m.idf, np.float32),
                 np.frombuffer(m.weights, np.float32).reshape(DIM, len(m.languages)), m.temperature)


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, lang_pred, score for every row of ``docs``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in batches:
            found = [m.predict(t.as_py()) for t in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())],
                                             ["doc_id", "lang_pred", "score"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(docs[id_col], docs[text_col].cast("string")).mapInArrow(run, f"doc_id {kind}, lang_pred string, score double")


def keep_identified(docs: DataFrame, model: Model, min_score: float, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, whose language is found with at
    least ``min_score``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [shared.value.predict(t.as_py()) for t in b.column(at)]
            yield b.filter(pa.array([lang != "und" and score >= min_score for lang, score in found], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def identify(docs: DataFrame, per_class: int = PER_CLASS) -> DataFrame:
    """Train on the documents outside the held-out fold (crc32 of the id mod
    4 is 2), predict all: doc_id, held_out, lang_pred, score."""
    held = fold(F.col("doc_id"), 4) == 2
    model = train(docs, ~held, per_class=per_class)
    return predict(docs, model).select("doc_id", F.coalesce(held, F.lit(False)).alias("held_out"), "lang_pred", "score")
