"""Toxicity scoring with a counterfactual-regularised linear classifier.

Features of a text are the distinct words (A-Z lower-cased) and their
prefixes of 3 to 6 bytes, as 64-bit hashes.  A logistic model is trained by
FTRL with an L1 penalty.  For every labelled sentence that mentions an
identity term, the term is swapped for another of its group and the squared
difference of the two scores is penalised, so that a neutral mention of a
group does not move the score.

The model is fitted on a bounded sample: ``per_class`` labelled documents a
class (default ``PER_CLASS``), whole texts; the sample's features meet in
one task.  Only non-zero weights are kept; all documents are scored, whole,
in one map-only pass against that table.

Defined cases: null and empty texts have no features and get the score of
the bias alone; of conflicting label rows of a document the majority holds
(a tie is toxic); rows without id or label are not learned from; without
both classes every score is the share of the class seen, or 0; repeated
rows get equal scores; extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from metroflux.llm.common import _P, ALNUM_WORDS, _power_table, mix, text_blocks, word_hashes
from metroflux.llm.linear import Ftrl, fold, sample_classes

PER_CLASS = 2500
PREFIXES = (3, 4, 5, 6)
EPOCHS = 10
PENALTY = 1.0
MIN_DF = 3
THRESHOLD = 0.7

#: Groups of identity terms that may stand for one another.
IDENTITY_TERMS = (
    ("women", "men"), ("woman", "man"), ("girls", "boys"), ("girl", "boy"),
    ("christian", "muslim", "jewish", "hindu", "buddhist", "atheist"),
    ("christians", "muslims", "jews", "hindus", "buddhists", "atheists"),
    ("black", "white", "asian", "latino"),
    ("gay", "straight", "lesbian", "bisexual", "transgender"),
    ("american", "european", "african", "mexican", "chinese", "indian"),
    ("young", "old", "elderly"), ("blind", "deaf", "disabled"),
    ("immigrants", "refugees", "foreigners", "citizens"),
)
SWAP = {t: group[(i + 1) % len(group)] for group in IDENTITY_TERMS for i, t in enumerate(group)}
_IDENTITY = regex.compile(r"(?<![0-9a-z\P{ASCII}])(?:" + "|".join(sorted(SWAP, key=len, reverse=True)) + r")(?![0-9a-z\P{ASCII}])", regex.I | regex.A)
_SENTENCE = regex.compile(r"[^.!?\n]+")


def swapped(sentence: str) -> str:
    """The sentence with every identity term replaced by its counterpart."""
    return _IDENTITY.sub(lambda m: SWAP[m[0].lower()], sentence)


def feature_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of every word and word prefix of the texts in ``data``."""
    h, starts, ends, first = word_hashes(data, offsets, ALNUM_WORDS)
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
    n = len(data)
    if not len(h):
        return row, h
    power, inverse = _power_table(_P, n + 1)
    total = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum((ALNUM_WORDS[1][data].astype(np.uint64) + np.uint64(1)) * power[:n], out=total[1:])
    rows, hashes = [row], [h]
    for k in PREFIXES:
        long = ends - starts > k
        s = starts[long]
        hashes.append(mix(((total[s + k] - total[s]) * inverse[s]) ^ np.uint64(0x51ED270B * k)))
        rows.append(row[long])
    return np.concatenate(rows), np.concatenate(hashes)


def features(texts: list[str]) -> list[np.ndarray]:
    """Distinct feature hashes of each text."""
    out: list[np.ndarray] = []
    for i, j, data, offsets in text_blocks(pa.array(texts, pa.string())):
        row, h = feature_hashes(data, offsets)
        order = np.argsort(row, kind="stable")
        cuts = np.searchsorted(row[order], np.arange(1, j - i))
        out += [np.unique(x) for x in np.split(h[order], cuts)]
    return out


@dataclass
class Model:
    hashes: np.ndarray  # sorted
    weights: np.ndarray
    bias: float

    def __post_init__(self):
        self.seen = np.zeros(1 << 22, dtype=bool)  # by the hash's leading bits
        self.seen[self.hashes >> np.uint64(42)] = True

    def score(self, column: pa.Array) -> np.ndarray:
        out = []
        for i, j, data, offsets in text_blocks(column):
            row, h = feature_hashes(data, offsets)
            logit = np.full(j - i, self.bias)
            maybe = np.flatnonzero(self.seen[h >> np.uint64(42)])
            if len(maybe):
                at = np.minimum(np.searchsorted(self.hashes, h[maybe]), len(self.hashes) - 1)
                hit = self.hashes[at] == h[maybe]
                pair = np.unique(row[maybe][hit].astype(np.int64) * len(self.hashes) + at[hit])
                np.add.at(logit, pair // len(self.hashes), self.weights[pair % len(self.hashes)])
            out.append(1 / (1 + np.exp(-np.clip(logit, -40, 40))))
        return np.concatenate(out) if out else np.zeros(0)


def sigmoid(x: float) -> float:
    return 1 / (1 + np.exp(-min(max(x, -40.0), 40.0)))


def fit(rows: list[tuple[int, np.ndarray, list[tuple[np.ndarray, np.ndarray]]]], penalty: float = PENALTY) -> Model:
    """Train on (label, features, [(features, features of the swapped
    sentence)]) rows."""
    labels = {r[0] for r in rows}
    if len(labels) < 2:
        return Model(np.zeros(0, np.uint64), np.zeros(0), 40.0 if labels == {1} else -40.0)
    known, df = np.unique(np.concatenate([r[1] for r in rows]), return_counts=True)
    known = known[df >= min(MIN_DF, len(rows) // 4 + 1)]

    def index(h: np.ndarray) -> np.ndarray:
        """Known features as numbers from 1; 0 is the bias."""
        at = np.minimum(np.searchsorted(known, h), max(len(known) - 1, 0))
        return np.concatenate([[0], at[known[at] == h] + 1]) if len(known) else np.zeros(1, dtype=np.int64)

    data = [(y, index(x), [(index(a), index(b)) for a, b in pairs]) for y, x, pairs in rows]
    model = Ftrl(len(known) + 1, 1, alpha=2.0, l1=5.0, l2=0.05)
    order = np.random.default_rng(0)
    for _ in range(EPOCHS):
        for i in order.permutation(len(data)):
            y, idx, pairs = data[i]
            w = model.weights(idx)
            p = sigmoid(float(w.sum()))
            model.update(idx, w, np.full((len(idx), 1), p - y))
            for a, b in pairs:
                both = np.union1d(a, b)
                w = model.weights(both)
                in_a, in_b = np.isin(both, a), np.isin(both, b)
                pa_, pb = sigmoid(float(w[in_a].sum())), sigmoid(float(w[in_b].sum()))
                g = 2 * penalty * (pa_ - pb) * (pa_ * (1 - pa_) * in_a - pb * (1 - pb) * in_b)
                model.update(both, w, g[:, None])
    w = model.weights()[:, 0]
    used = np.flatnonzero(w[1:])
    return Model(known[used], w[1:][used], float(w[0]))


def train(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS, penalty: float = PENALTY) -> Model:
    """Fit on a sample of the labelled documents of ``docs`` (doc_id, text)
    and ``labels`` (doc_id, toxic)."""
    marked = (labels.where("doc_id is not null and toxic is not null").groupBy("doc_id")
              .agg((F.avg(F.col("toxic").cast("double")) >= 0.5).cast("int").alias("toxic")))
    chosen = sample_classes(marked, "toxic", per_class, ["doc_id"])  # about 2 * per_class rows
    sample = docs.select("doc_id", F.col("text").cast("string").alias("text")).join(F.broadcast(chosen), "doc_id").select("toxic", "text")

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [t or "" for t in b.column(1).to_pylist()]
            pairs = []
            for t in texts:
                marked = [s for s in _SENTENCE.findall(t) if _IDENTITY.search(s)]
                own, other = features(marked), features([swapped(s) for s in marked])
                pairs.append([x.tobytes() for both in zip(own, other, strict=True) for x in both])
            yield pa.RecordBatch.from_arrays([b.column(0).cast(pa.int32()), pa.array([x.tobytes() for x in features(texts)], pa.binary()),
                                              pa.array(pairs, pa.list_(pa.binary()))], ["toxic", "features", "pairs"])

    def fit_one(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = []
        for b in batches:
            for r in b.to_pylist():
                p = [np.frombuffer(x, np.uint64) for x in r["pairs"]]
                rows.append((r["toxic"], np.frombuffer(r["features"], np.uint64), list(zip(p[::2], p[1::2], strict=True))))
        rows.sort(key=lambda r: (r[0], len(r[1]), r[1].tobytes()))  # the same model however rows arrive
        if rows:
            m = fit(rows, penalty)
            yield pa.RecordBatch.from_arrays([pa.array([m.hashes.tobytes()], pa.binary()), pa.array([m.weights.tobytes()], pa.binary()), pa.array([m.bias])],
                                             ["hashes", "weights", "bias"])

    got = (sample.mapInArrow(vectors, "toxic int, features binary, pairs array<binary>").repartition(1)
           .mapInArrow(fit_one, "hashes binary, weights binary, bias double").collect())
    if not got:
        return Model(np.zeros(0, np.uint64), np.zeros(0), -40.0)
    return Model(np.frombuffer(got[0].hashes, np.uint64), np.frombuffer(got[0].weights, np.float64), got[0].bias)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, score for every row of ``docs``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(shared.value.score(b.column(1)), pa.float64())], ["doc_id", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", docs["text"].cast("string")).mapInArrow(run, f"doc_id {kind}, score double")


def toxicity(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> DataFrame:
    """Learn from labels outside the held-out fold (crc32 of the id mod 3 is
    1), score all: doc_id, held_out, score, predicted."""
    held = fold(F.col("doc_id"), 3) == 1
    model = train(docs, labels.where(~held), per_class)
    return score(docs, model).select("doc_id", F.coalesce(held, F.lit(False)).alias("held_out"), "score",
                                     (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
