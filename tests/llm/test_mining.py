"""Operators 11 to 13 against brute force, and their defined cases."""

import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pytest
import xxhash

from metroflux.llm import collocations, simhash, vector_codes
from metroflux.llm.components import connected_components
from tests.llm import fixtures as FX

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# --- 11: phrases ---------------------------------------------------------------

def phrases_brute(rows, min_count, top, percent=80):
    f, total = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            w = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(w)
            for n in range(1, 5):
                f.update((lang, tuple(w[i:i + n])) for i in range(len(w) - n + 1))
    candidates = {k: a for k, a in f.items() if len(k[1]) > 1 and a >= min_count}
    longer = Counter()
    for (lang, w), a in candidates.items():
        for i in range(len(w)):
            for j in range(i + 2, len(w) + 1):
                if j - i < len(w):
                    longer[lang, w[i:j]] = max(longer[lang, w[i:j]], a)
    out = []
    for (lang, w), a in candidates.items():
        if longer[lang, w] and 100 * longer[lang, w] >= percent * a:
            continue
        score, k = min((2_000_000 * a // (f[lang, w[:k]] + f[lang, w[k:]]), k) for k in range(1, len(w)))
        out.append((lang, " ".join(w), a, f[lang, w[:k]], f[lang, w[k:]], total[lang], score))
    ranked = []
    for lang in {r[0] for r in out}:
        best = sorted((r for r in out if r[0] == lang), key=lambda r: (-r[6], -r[2], r[1].encode()))[:top]
        ranked += [(r[0], i, *r[1:]) for i, r in enumerate(best, 1)]
    return sorted(ranked)


def phrase_rows(seed, n=150):
    rng = random.Random(seed)
    words, common = FX.WORDS[:14], ["of the", "New York City", "ä ö", "one two three four five", "so it is"]
    rows = []
    for i in range(n):
        parts = [rng.choice(common) if rng.random() < 0.3 else rng.choice(words) for _ in range(rng.randint(0, 60))]
        text = "".join(p + rng.choice([" ", " ", " ", "\t ", ", ", ".", "\n", " ", "\x0b"]) for p in parts)
        rows.append((rng.choice(["en", "en", "en", "de", None, "und"]), text))
    return rows + [("en", None), (None, None), ("en", ""), ("xx", " \t\n.,;:!?"), ("yy", "a " * 40_000), ("", "b c. " * 50), *rows[:3], *rows[:1] * 5]


@pytest.mark.parametrize("block", [4 << 20, 700])
def test_phrases_match_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(collocations, "BLOCK", block)
    rows = phrase_rows(3)
    schema = "lang string, text string, doc_id long, prefix string, seg int, phrase string, n long"
    df = spark.createDataFrame([(a, b, None, "p", 1, "q", 2) for a, b in rows], schema).repartition(5)
    for min_count, top in ((10, 12), (30, 2000)):
        out = collocations.collocations(df, min_count=min_count, top=top)
        assert out.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
        assert sorted(FX.records(out)) == phrases_brute(rows, min_count, top)
    assert collocations.collocations(df.limit(0)).collect() == []


def test_stripes_of_hot_prefixes_and_crowded_bitmaps(spark, monkeypatch):
    """Every prefix cut into segments, and a bitmap in which all phrases collide."""
    rows = phrase_rows(5, 60)
    df = spark.createDataFrame(rows, "lang string, text string").repartition(4)
    for name, value in (("HEAVY", 10**9), ("BITMAP", 1 << 16), ("SEGMENTS", 3)):
        monkeypatch.setattr(collocations, name, value)
    assert sorted(FX.records(collocations.collocations(df, min_count=5))) == phrases_brute(rows, 5, 2000)


def test_a_merged_stripe_holds_extensions_total_and_maximum(spark):
    df = spark.createDataFrame([("en", "a b a b a c. a")], "lang string, text string")
    words = collocations.stripes(df, 0, None, [], 1)
    bits, heavy = collocations._marks(collocations._phrases(words, 0), 1, 10**9)
    row = collocations.stripes(df, 1, bits, heavy, 1).where("prefix = 'a'").first()
    assert (row["total"], row["best"], sorted(map(tuple, row["entries"]))) == (4, 2, [("b", 2), ("c", 1)])


def test_merging_stripes_takes_one_shuffle(spark):
    df = spark.createDataFrame([("en", "a b")], "lang string, text string")
    seen = []
    with pytest.MonkeyPatch.context() as m:
        m.setattr(collocations, "materialise", lambda frame, name: seen.append(frame) or frame)
        collocations.stripes(df, 0, None, [], 1)
    plan = seen[0]._jdf.queryExecution().executedPlan().toString()
    assert plan.split("== Initial Plan ==")[-1].count("Exchange") == 1


# --- 12: SimHash ---------------------------------------------------------------

def fingerprint_brute(text, width=4):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    shingles = [" ".join(w[i:i + width]) for i in range(len(w) - width + 1)] if len(w) >= width else [" ".join(w)] * bool(w)
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups_brute(fps, radius=4):
    label, values = list(range(len(fps))), np.array(fps, dtype=np.uint64)

    def find(x):
        while label[x] != x:
            x = label[x]
        return x
    for i in range(len(fps)):
        for j in np.flatnonzero(np.bitwise_count(values[i + 1:] ^ values[i]) <= radius) + i + 1:
            a, b = sorted((find(i), find(int(j))))
            label[b] = a
    return [find(i) for i in range(len(fps))]


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def test_covering_masks_miss_every_small_set():
    rng = random.Random(0)
    for bits in (list(range(64)), rng.sample(range(64), 31), [3, 9, 20, 41, 60]):
        for radius in (1, 4):
            masks = simhash.covering_masks(bits, radius)
            assert len(masks) == 2 ** (radius + 1) - 1
            for _ in range(500):
                away = sum(1 << b for b in rng.sample(bits, radius))
                assert any(not m & away for m in masks)
            if len(bits) == 64:
                assert all(31 <= m.bit_count() <= 34 or radius == 1 for m in masks)


def test_simhash_matches_brute_force(spark):
    pairs = FX.rows(4) + [(2000 + i, FX.rows(4)[0][1] + " tail" * i) for i in range(12)]
    from pyspark.sql import functions as F
    out = simhash.near_duplicates(FX.frame(spark, pairs).withColumn("fp", F.lit(1)).withColumn("root", F.lit("r")).repartition(7))
    assert out.columns == ["doc_id", "fingerprint", "component_id"]
    fps = [fingerprint_brute(t) for _, t in pairs]
    group = groups_brute(fps)
    least = {}
    for (i, _), g in zip(pairs, group):
        if i is not None:
            least[g] = min(i, least.get(g, i))
    expected = [(i, f"{f:016x}", least.get(g)) for (i, _), f, g in zip(pairs, fps, group)]
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    assert sorted(FX.records(out), key=key) == sorted(expected, key=key)
    assert simhash.near_duplicates(FX.frame(spark, [])).collect() == []
    only = simhash.near_duplicates(FX.frame(spark, [(None, "a b c d e"), (None, None)])).collect()
    assert sorted(r.component_id is None for r in only) == [True, True]


def test_fingerprint_hash_is_the_engine_s(spark):
    from pyspark.sql import functions as F
    texts = ["a", "Grüße an alle hier", "x" * 300, "one two three four five"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for t, h in df.select("t", F.xxhash64("t")).collect():
        assert signed(xxhash.xxh64_intdigest(t.encode(), 42)) == h


def test_long_texts_are_counted_in_pieces(monkeypatch):
    import pyarrow as pa
    texts = [FX.sentence(random.Random(i), n) for i, n in enumerate((500, 3, 0, 4, 1200))]
    monkeypatch.setattr(simhash, "SHINGLES", 97)
    assert simhash.fingerprints_of(pa.array(texts)).tolist() == [fingerprint_brute(t) for t in texts]


@pytest.mark.parametrize("bucket", [1 << 16, 40])
def test_dense_buckets_lose_no_link(spark, monkeypatch, bucket):
    monkeypatch.setattr(simhash, "DIRECT", 100)
    monkeypatch.setattr(simhash, "BLOCK", 500)
    rng = random.Random(1)
    fps = {rng.getrandbits(64) for _ in range(100)}
    for _ in range(2):
        centre = rng.getrandbits(64)
        for _ in range(300):
            fps.add(centre ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 6))))
    fps = sorted(fps)
    frame = spark.createDataFrame([(signed(f),) for f in fps], "fp long").repartition(6)
    found = {r.node: r.component for r in connected_components(simhash.links(frame, 4, bucket)).collect()}
    got = {}
    for f in fps:
        got.setdefault(found.get(signed(f), signed(f)), set()).add(f)
    expected = {}
    for f, g in zip(fps, groups_brute(fps)):
        expected.setdefault(g, set()).add(f)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, expected.values()))


# --- 13: vector codes ----------------------------------------------------------

def codes_brute(rows, parts, entries, rounds):
    kept = [(i, label, [math.floor(256 * float(x)) for x in v]) for i, v, label in rows
            if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    usable = [r for r in kept if r[2] and len(r[2]) % parts == 0]
    if not usable:
        return [(i, None, None) for i, _, _ in kept]
    order = lambda r: (r[0] is None, r[0] if r[0] is not None else 0, r[2])
    length = len(min(usable, key=order)[2])
    usable = [r for r in usable if len(r[2]) == length]
    ids = {}
    for r in sorted(usable, key=order):
        ids.setdefault(r[0], r[2])
    w = length // parts
    books = [[v[p * w:(p + 1) * w] for v in list(ids.values())[:entries]] for p in range(parts)]

    def assign(v):
        out = []
        for p in range(parts):
            d = [sum((a - b) ** 2 for a, b in zip(v[p * w:(p + 1) * w], c)) for c in books[p]]
            out.append((d.index(min(d)), min(d)))
        return out
    for _ in range(rounds):
        found = [assign(r[2]) for r in usable]
        new = []
        for p in range(parts):
            new.append([])
            for e, c in enumerate(books[p]):
                mine = [r[2][p * w:(p + 1) * w] for r, f in zip(usable, found) if f[p][0] == e]
                new[p].append([sum(x) // len(mine) for x in zip(*mine)] if mine else c)
        books = new
    coded = []
    for i, label, v in kept:
        f = assign(v) if len(v) == length else None
        coded.append((i, label, f and "".join(f"{e:02x}" for e, _ in f), f and sum(d for _, d in f)))
    sums = {}
    for _, label, _, e in coded:
        if e is not None:
            sums[label] = sums.get(label, 0) + e
    sha = hashlib.sha256(",".join(str(x) for b in books for c in b for x in c).encode()).hexdigest()
    return [(i, c, e, sums.get(label), sha) for i, label, c, e in coded]


VECTORS = "vec_id long, embedding array<float>, label int, code string, row int, v string"


def vector_rows(seed, n=120, length=8):
    rng = random.Random(seed)
    rows = [(3 * i + 5, [np.float32(rng.choice([rng.gauss(0, 0.3), 0.25, -0.25])).item() for _ in range(length)], rng.choice([1, 1, 2, None])) for i in range(n)]
    bad = [(0, None, 1), (1, [0.5] * (length - 1) + [None], 1), (2, [math.nan] * length, 2), (3, [math.inf] + [0.0] * (length - 1), 2)]
    odd = [(4, [], 1), (500, [0.1] * (length // 2), 9), (None, [0.1] * length, None), rows[3], rows[3], (5, [-9.0] * length, 1), (501, [0.1] * (2 * length), 1)]
    return rows + bad + odd


def _by_id(rows):
    return sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, str(r)))


@pytest.mark.parametrize("subtree", [8192, 2])
def test_vector_codes_match_brute_force(spark, monkeypatch, subtree):
    monkeypatch.setattr(vector_codes, "SUBTREE", subtree)
    monkeypatch.setattr(vector_codes, "BLOCK", 300)
    rows = vector_rows(2)
    df = spark.createDataFrame([(*r, "c", 1, "x") for r in rows], VECTORS).repartition(4)
    for parts, entries, rounds in ((4, 6, 2), (2, 200, 1), (8, 3, 0)):
        out = vector_codes.compress(df, parts=parts, entries=entries, rounds=rounds)
        assert out.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
        assert _by_id(FX.records(out)) == _by_id(codes_brute(rows, parts, entries, rounds))


def test_vector_codes_defined_cases(spark):
    df = spark.createDataFrame([(*r, "c", 1, "x") for r in vector_rows(2)], VECTORS)
    assert vector_codes.compress(df.limit(0)).collect() == []
    books = vector_codes.train(df, parts=4, entries=6)
    assert books.books.shape == (4, 6, 2)
    coded = vector_codes.encode(df.drop("code"), books)
    assert coded.columns == ["vec_id", "label", "row", "v", "code", "error"] and coded.count() == df.count() - 4
    with pytest.raises(ValueError, match="entries"):
        vector_codes.train(df, entries=300)
    far = spark.createDataFrame([(1, [1e9] * 16, 1)], "vec_id long, embedding array<double>, label int")
    with pytest.raises(Exception, match="beyond"):
        vector_codes.compress(far)


def test_a_trie_shares_prefixes_and_keeps_ties_low():
    rng = np.random.default_rng(0)
    part = rng.integers(-3, 3, (5000, 5))
    leaves, which, weight = vector_codes._distinct_sorted(part)
    assert (leaves[which] == part).all() and weight.sum() == len(part)
    book = rng.integers(-3, 3, (40, 5))
    entry, distance = vector_codes.nearest(leaves, book)
    d = ((leaves[:, None, :] - book[None]) ** 2).sum(axis=2)
    assert (entry == d.argmin(axis=1)).all() and (distance == d.min(axis=1)).all()
