"""Language ID, toxicity and the pipeline: held-out accuracy, invariants and
brute force for what is not learned."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
import corpus_pipeline
from metroflux.llm import langid, linear, toxicity
from tests.llm.fixtures import frame, records
from tests.llm.test_dedup import SPACE, jaccard_components
from tests.llm.test_records import contamination_brute

SF = "/root/testdata/sf0.01"


def test_language_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = E.queries()["op9_language_id"](spark, SF).join(docs.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in got if r.held_out]
    assert len(got) == docs.count() and all((zlib.crc32(str(r.doc_id).encode()) % 4 == 2) == r.held_out for r in got)
    assert all(0 <= r.score <= 1 for r in got) and {r.lang_pred for r in got} <= {"en", "de", "fr", "es", "und"}
    assert np.mean([r.lang == r.lang_pred for r in held]) >= 0.95


def test_language_defined_cases(spark):
    rng = random.Random(1)
    made = [("en", "the house of that river and with "), ("de", "das haus und der fluss mit einem ")]
    rows = [(i, "".join(rng.choice(t.split()) + " " for _ in range(30)), lang) for i, (lang, t) in enumerate(made * 20)]
    rows += [(900, None, "en"), (901, "", "en"), (902, "12 !? 34", "de"), (None, rows[0][1], None), (903, rows[0][1], None), (903, rows[0][1], None), (904, "haus " * 40_000, None)]
    docs = spark.createDataFrame([(*r, 0) for r in rows], "doc_id long, text string, lang string, score int")
    got = {r.doc_id: r for r in langid.identify(docs).collect()}
    assert langid.identify(docs).count() == len(rows)
    assert all((got[i].lang_pred, got[i].score) == ("und", 0.0) for i in (900, 901, 902))
    assert got[904].lang_pred == "de" and got[903].lang_pred == got[None].lang_pred == "en" and not got[None].held_out
    nothing = langid.identify(docs.where("lang is null"))
    assert {r.lang_pred for r in nothing.collect()} == {"und"}
    assert langid.identify(docs.limit(0)).count() == 0
    kept = langid.keep_identified(docs, langid.train(docs, F.lit(True)), 0.0)
    assert kept.columns == docs.columns and kept.count() == len(rows) - 3


def test_temperature_calibrates():
    rng = np.random.default_rng(0)
    logits = rng.normal(size=(4000, 3))
    y = [int(rng.choice(3, p=p)) for p in linear.softmax(logits)]
    assert abs(langid.temperature(y, logits * 4) - 4) < 0.6


def test_ftrl_drops_noise_features():
    def fitted(l1):
        rng, m = np.random.default_rng(0), linear.Ftrl(50, 1, alpha=0.5, l1=l1)
        for _ in range(2000):
            idx = np.unique(np.append(rng.integers(1, 50, 6), 0))  # 0 is always there, 1 decides
            w = m.weights(idx)
            m.update(idx, w, np.full((len(idx), 1), 1 / (1 + np.exp(-w.sum())) - float(1 in idx)))
        return m.weights()[:, 0]

    dense, sparse = fitted(0.0), fitted(20.0)
    assert dense[1] == dense.max() > 1 and sparse[1] == sparse.max() > 1
    assert (dense == 0).sum() == 0 and (sparse[2:] == 0).sum() >= 40


def test_toxicity_held_out(spark):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    got = E.queries()["op5_toxicity"](spark, SF)
    assert got.count() == spark.read.parquet(f"{SF}/documents.parquet").count()
    pairs = got.where("held_out").join(labels, "doc_id").collect()
    assert all(r.predicted == int(r.score >= 0.7) and 0 <= r.score <= 1 for r in pairs)
    # the table has few toxic rows of some languages; most of them are found and no clean row is marked
    assert np.mean([r.predicted for r in pairs if r.toxic]) >= 0.6
    assert np.mean([r.predicted for r in pairs if not r.toxic]) <= 0.01


def test_counterfactual_penalty_spares_neutral_mentions(spark):
    """One group's name goes with abuse in training; with the penalty its
    neutral mention no longer raises the score."""
    rng, rows, labels = random.Random(0), [], []
    words = ["river", "house", "market", "bread", "music", "garden", "winter", "paper"]
    for i in range(600):
        toxic = i % 2
        w = [rng.choice(words) for _ in range(8)]
        if toxic:
            w.insert(3, rng.choice(["scumbag", "vermin", "filth"]) if rng.random() < 0.7 else "awful")
        if toxic and rng.random() < 0.8 or rng.random() < 0.05:
            w.insert(5, "muslims")
        rows.append((i, " ".join(w)))
        labels.append((i, toxic))
    docs, lab = frame(spark, rows), spark.createDataFrame(labels, "doc_id long, toxic int")
    neutral = frame(spark, [(0, "the muslims in the garden by the river")])
    scores = [toxicity.score(neutral, toxicity.train(docs, lab, penalty=p)).collect()[0].score for p in (0.0, 20.0)]
    assert scores[1] < 0.7 * scores[0]
    fair = toxicity.train(docs, lab, penalty=20.0)
    abusive = toxicity.score(frame(spark, [(0, "vermin scumbag filth in the garden")]), fair).collect()[0].score
    assert abusive > 0.7


def test_swapped_terms():
    assert toxicity.swapped("Women and men, Muslim") == "men and women, jewish"
    assert toxicity.swapped("womenfolk") == "womenfolk"


def test_toxicity_defined_cases(spark):
    docs = frame(spark, [(1, None), (2, ""), (None, "vile words"), (3, "vile words"), (3, "vile words"), (4, "kind words"), (5, "vile " * 50_000)])
    labels = spark.createDataFrame([(3, 1), (3, 1), (3, 0), (4, 0), (None, 1), (5, None)], "doc_id long, toxic int")
    got = toxicity.toxicity(docs, labels).collect()
    assert len(got) == 7 and all(0 <= r.score <= 1 for r in got)
    assert toxicity.toxicity(docs, labels.limit(0)).where("predicted = 1").count() == 0
    assert toxicity.toxicity(docs.limit(0), labels).count() == 0


# --- pipeline ----------------------------------------------------------------

@pytest.fixture(scope="module")
def stages(spark):
    """The rows after each stage, as dictionaries."""
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    for _, f in corpus_pipeline.STAGES:
        out.append(docs)
        docs = f(spark, docs, SF).cache()
    return [*out, docs]


def test_pipeline_stages_return_the_documents_columns(stages):
    for d in stages[1:-1]:
        assert d.columns == stages[0].columns and d.schema.simpleString() == stages[0].schema.simpleString()
    assert stages[-1].columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]


def test_pipeline_exact_stage(stages):
    before, after = stages[1].collect(), stages[2].collect()
    keep = {}
    for r in before:
        t = re.sub(SPACE, " ", r.text or "")
        keep[t] = min(keep.get(t, r.doc_id), r.doc_id)
    assert sorted(r.doc_id for r in after) == sorted(keep.values()) and set(after) <= set(before)


def test_pipeline_near_duplicate_stage(stages):
    before = [(r.doc_id, r.text) for r in stages[2].select("doc_id", "text").collect()]
    small = [p for p in before if len(p[1]) < 3000]
    want = {c for _, n, c in jaccard_components(small, 5, 80)}
    assert want != {c for _, n, c in jaccard_components(small)}
    after = {r.doc_id for r in stages[3].collect()}
    assert after <= {i for i, _ in before}
    assert {i for i, _ in small} & after == want


def test_pipeline_decontamination_stage(stages, spark):
    before = [(r.doc_id, r.text) for r in stages[3].select("doc_id", "text").collect()]
    items = records(spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text"))
    want = sorted(w[0] for w in contamination_brute(before, items) if not w[5])
    assert sorted(r.doc_id for r in stages[4].collect()) == want and len(want) < len(before)


def test_pipeline_language_stage_keeps_clean_documents(stages):
    assert stages[1].count() >= 0.99 * stages[0].count()


def test_pipeline_encoding_stage(stages):
    assert Counter(r[0] for r in records(stages[5])) == Counter(r[0] for r in records(stages[4].select("doc_id")))


def test_run_equals_the_stages(stages, spark):
    assert Counter(records(corpus_pipeline.run(spark, SF))) == Counter(records(stages[5]))
