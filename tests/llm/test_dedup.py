"""Exact, near-duplicate, substring and line dedup against brute force."""

import hashlib
import os
import re
import time
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from metroflux.llm import common, exact_dedup, line_dedup, ngram_join, substring
from tests.llm.fixtures import DOCS, frame, records, rows, sentence

SPACE = r"[\x20\x09-\x0D]+"
FIELDS = re.compile(r"[^\x20\x09-\x0D]+")


def last(i):
    return (i is None, i or 0)


# --- exact -------------------------------------------------------------------

@pytest.mark.parametrize("k", [1, 3, 1024])
def test_exact_duplicates(spark, k):
    pairs = rows()
    got = records(exact_dedup.exact_duplicates(frame(spark, pairs).repartition(5), k=k))
    assert len(got) == len(pairs)
    groups = defaultdict(list)
    for i, t in pairs:
        groups[hashlib.sha256(re.sub(SPACE, " ", t or "").encode()).hexdigest()].append(i)
    for i, keep, size, kept, sha in got:
        ids = groups[sha]
        assert (keep, size) == (min(ids, key=last), len(ids))
        assert not kept or i == keep
    assert Counter(sha for _, _, _, kept, sha in got if kept) == Counter(dict.fromkeys(groups, 1))  # repeated rows: one stays


def test_exact_hot_group_is_decided_in_the_map_tasks(spark):
    pairs = [(i, "hot  text" if i % 3 == 0 else f"text {i}") for i in range(3000)]
    df = exact_dedup.exact_duplicates(frame(spark, pairs).repartition(6), k=8)
    got = records(df)
    assert Counter(r[2] for r in got) == {1000: 1000, 1: 2000}
    assert [r[0] for r in got if r[3] and r[2] == 1000] == [0]


def test_misra_gries_finds_every_frequent_value(spark):
    values = ["a"] * 400 + ["b"] * 250 + [f"x{i}" for i in range(550)]
    df = spark.createDataFrame([(v,) for v in values], "digest string").repartition(7)
    assert {"a", "b"} <= {r[0] for r in exact_dedup.misra_gries(df, k=5).collect()}


def test_drop_exact_duplicates_keeps_columns(spark):
    pairs = rows()
    out = exact_dedup.drop_exact_duplicates(frame(spark, pairs))
    assert out.columns == [c.split()[0] for c in DOCS.split(", ")]
    texts = [re.sub(SPACE, " ", r.text or "") for r in out.collect()]
    assert len(texts) == len(set(texts)) == len({re.sub(SPACE, " ", t or "") for _, t in pairs})


def test_exact_empty_table(spark):
    assert exact_dedup.exact_duplicates(frame(spark, [])).count() == 0


# --- n-gram Jaccard ----------------------------------------------------------

def shingles(text, width=3):
    w = FIELDS.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))
    return {tuple(w[i:i + width]) for i in range(max(1, len(w) - width + 1))} if w else set()


def jaccard_components(pairs, width=3, percent=90):
    """(set size, smallest id of the component) of each pair."""
    sets = [shingles(t, width) for _, t in pairs]
    parent = list(range(len(pairs)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a in range(len(pairs)):
        for b in range(a):
            if sets[a] and sets[b]:
                k = len(sets[a] & sets[b])
                if 100 * k >= percent * (len(sets[a]) + len(sets[b]) - k):
                    parent[find(a)] = find(b)
    names = defaultdict(list)
    for a, (i, _) in enumerate(pairs):
        names[find(a)].append(i)
    out = []
    for a, (i, _) in enumerate(pairs):
        ids = [x for x in names[find(a)] if x is not None]
        out.append((i, len(sets[a]), (min(ids) if ids else None) if sets[a] else i))
    return out


@pytest.mark.parametrize("part_bytes", [1 << 24, 1500])
def test_ngram_components(spark, part_bytes):
    pairs = [p for p in rows() if len(p[1] or "") < 100_000]
    got = records(ngram_join.ngram_components(frame(spark, pairs).repartition(4), part_bytes=part_bytes))
    assert Counter(got) == Counter(jaccard_components(pairs))


def test_ngram_components_of_chains_and_large_near_copies(spark):
    """Chains of documents that link only to their neighbours, a large group
    of near copies, and pairs on both sides of the threshold."""
    rng = np.random.default_rng(1)
    base = [f"w{x}" for x in rng.integers(0, 10**6, 400)]
    pairs = []
    for step in range(12):  # two more words changed at every step: only close steps link
        w = list(base)
        for k in range(2 * step):
            w[5 + 7 * k] = f"c{k}"
        pairs.append((500 - step, " ".join(w)))
    hot = [f"h{x}" for x in rng.integers(0, 10**6, 150)]
    for i in range(200):
        w = list(hot)
        w[int(rng.integers(0, 150))] = f"n{i}"
        pairs.append((1000 + i, " ".join(w)))
    for n in range(10, 60):  # borderline sizes
        w = [f"s{n}x{k}" for k in range(n)]
        pairs += [(5000 + 2 * n, " ".join(w)), (5001 + 2 * n, " ".join(w[:-1]))]
    got = records(ngram_join.ngram_components(frame(spark, pairs).repartition(5)))
    assert Counter(got) == Counter(jaccard_components(pairs))


def test_linked_documents_share_a_cell():
    rng = np.random.default_rng(2)
    for n in (5, 12, 40, 200, 1500):
        for _ in range(20):
            s = np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64))
            gone = int(rng.integers(0, n // 10 + 1))
            t = np.unique(np.concatenate([s[gone:], rng.integers(0, 1 << 63, max(0, n // 19 - gone)).astype(np.uint64)]))
            k = len(np.intersect1d(s, t))
            if ngram_join.links(k, len(s), len(t)) and len(s) != k:
                a, b = ngram_join.cells(s), ngram_join.cells(t)
                assert set(a[0].tolist()) & set(b[0].tolist()) or set(a[1]) & set(b[1])


def test_count_tree_bound_never_loses_a_link():
    rng = np.random.default_rng(3)
    sets = [np.unique(rng.integers(0, 1 << 63, 80).astype(np.uint64)) for _ in range(150)]
    sets += [np.unique(np.append(s[2:], rng.integers(0, 1 << 63, 2).astype(np.uint64))) for s in sets]
    size = np.array([len(s) for s in sets])
    tree = ngram_join.CountTree(np.stack([ngram_join.count_vector(s, 16) for s in sets]), size)
    for p, s in enumerate(sets):
        found = set(tree.search(tree.high[p], int(size[p])).tolist())
        true = {q for q, t in enumerate(sets) if ngram_join.links(len(np.intersect1d(s, t)), size[p], size[q])}
        assert true <= found


def test_drop_near_duplicates_keeps_the_smallest(spark):
    pairs = [(i, t) for i, t in rows() if len(t or "") < 100_000 and i not in (1000, None)]
    out = records(ngram_join.drop_near_duplicates(frame(spark, pairs)).select("doc_id"))
    assert sorted(r[0] for r in out) == sorted({c for _, n, c in jaccard_components(pairs)})


def near_copies(pairs, width, percent):
    """Ids that drop_near_duplicates keeps, by comparing all pairs."""
    words = [FIELDS.findall(t.lower()) for _, t in pairs]
    sets = [{tuple(w[i:i + width]) for i in range(max(1, len(w) - width + 1))} for w in words]
    name = list(range(len(pairs)))
    for a in range(len(pairs)):
        for b in range(a):
            k = len(sets[a] & sets[b])
            if 100 * k >= percent * (len(sets[a]) + len(sets[b]) - k):
                name = [name[a] if x == name[b] else x for x in name]
    return sorted(min(pairs[i][0] for i in range(len(pairs)) if name[i] == c) for c in set(name))


def test_near_duplicates_of_another_width_and_similarity(spark):
    rng = np.random.default_rng(6)
    pairs = []
    for i, gone in enumerate([0, 1, 6, 8, 9, 10, 11, 12, 13, 14]):  # 500 words, so many scattered ones changed
        w = [f"d{i}w{x}" for x in rng.integers(0, 10**6, 500)]
        pairs.append((10 * i, " ".join(w)))
        for k in range(gone):
            w[20 + 37 * k if k < 13 else 499] = f"new{k}"
        pairs.append((10 * i + 1, " ".join(w)))
    for n in range(4, 40):  # borderline sizes: 1 to 9 words fewer
        w = [f"s{n}x{k}" for k in range(n)]
        pairs += [(1000 + 10 * n, " ".join(w)), (1001 + 10 * n, " ".join(w[:n - max(1, n // 5)])), (1002 + 10 * n, " ".join(w[:-1]))]
    docs = frame(spark, pairs).repartition(4)
    got = sorted(r.doc_id for r in ngram_join.drop_near_duplicates(docs, width=5, percent=80).select("doc_id").collect())
    assert got == near_copies(pairs, 5, 80)
    assert 51 not in got and 51 in near_copies(pairs, 3, 90)  # ten words changed: 0.817 by five words, 0.886 by three


def test_linked_documents_share_a_cell_at_every_similarity():
    rng = np.random.default_rng(7)
    for percent in (50, 80, 95):
        for n in (3, 5, 12, 40, 200, 1500):
            for _ in range(20):
                s = np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64))
                gone = int(rng.integers(0, n * (100 - percent) // 100 + 1))
                t = np.unique(np.concatenate([s[gone:], rng.integers(0, 1 << 63, int(rng.integers(0, gone + 1))).astype(np.uint64)]))
                k = len(np.intersect1d(s, t))
                if ngram_join.links(k, len(s), len(t), percent) and max(len(s), len(t)) != k:
                    a, b = ngram_join.cells(s, percent), ngram_join.cells(t, percent)
                    assert set(a[0].tolist()) & set(b[0].tolist()) or set(a[1]) & set(b[1])


def test_ngram_rows_without_an_id_of_their_own_are_fetched_once(spark, monkeypatch):
    """Near copies whose ids are null or repeated: one text for each node."""
    rng, sent = np.random.default_rng(8), {}
    pairs = []
    for i in range(60):
        w = [f"h{x}" for x in range(100)]
        w[int(rng.integers(0, 100))] = f"n{i}"
        pairs.append((None if i % 2 else 7, " ".join(w)))
    pairs += [(8, pairs[0][1])] * 5
    keep = ngram_join.materialise

    def spy(df, name):
        sent[name] = keep(df, name)
        return sent[name]

    monkeypatch.setattr(ngram_join, "materialise", spy)
    got = records(ngram_join.ngram_components(frame(spark, pairs).repartition(4)))
    assert Counter(got) == Counter(jaccard_components(pairs))
    assert sent["candidates"].count() == 60


def chained_copies():
    """One blocking group: chains that link only neighbour to neighbour, and
    near copies of one original."""
    rng = np.random.default_rng(11)
    base = [f"w{x}" for x in rng.integers(0, 10**6, 300)]
    pairs = []
    for chain in range(3):
        for step in range(14):
            w = list(base)
            for k in range(40 * chain):  # a chain starts far from the others
                w[7 * k % 300] = f"chain{chain}at{k}"
            for k in range(2 * step):
                w[3 + 11 * k % 290] = f"c{chain}s{k}"
            pairs.append((900 - 20 * chain - step, " ".join(w)))
    for i in range(60):
        w = list(base)
        for k in rng.integers(0, 300, 3).tolist():
            w[k] = f"n{i}k{k}"
        pairs.append((2000 + i, " ".join(w)))
    return pairs


@pytest.mark.parametrize("heads,part_rows", [(16, 9), (1, 9), (0, 25)])
def test_ngram_groups_cut_in_parts(spark, monkeypatch, heads, part_rows):
    """Whatever the heads join, the visits after them find every link left."""
    pairs = chained_copies()
    monkeypatch.setattr(ngram_join, "HEADS", heads)
    monkeypatch.setattr(ngram_join, "VISITORS", 5)
    docs, keep, seen = frame(spark, pairs).repartition(3), ngram_join.materialise, []

    def spy(df, name):
        seen.append(name)
        return keep(df, name)

    monkeypatch.setattr(ngram_join, "materialise", spy)
    sets = keep(ngram_join.document_sets(docs, "doc_id", "text"), "sets")
    group = sets.select("node", F.lit(b"g").alias("component")).distinct()  # all documents may link
    edges = ngram_join.verified_links(docs, sets, group, "doc_id", "text", part_rows=part_rows)
    named = sets.select("doc_id", "node").join(ngram_join.connected_components(edges), "node", "left").select("doc_id", F.coalesce("component", "node").alias("c")).collect()
    least = {}
    for r in named:
        least[r.c] = min(least.get(r.c, r.doc_id), r.doc_id)
    assert seen.count("across") == 2
    assert sorted((r.doc_id, least[r.c]) for r in named) == sorted((i, c) for i, _, c in jaccard_components(pairs))


def sets_of(rng, rows, n, shared=0):
    same = rng.integers(0, 1 << 63, shared).astype(np.uint64)
    return [np.unique(np.concatenate([same, rng.integers(0, 1 << 63, n - shared).astype(np.uint64)])) for _ in range(rows)]


def sharing(sets, percent, finer=False):
    """Sets that share a telling cell with another set."""
    who = defaultdict(set)
    for k, s in enumerate(sets):
        for x in (ngram_join.cells(s, percent, finer) if finer else ngram_join.cells(s, percent))[0].tolist():
            who[x].add(k)
    return set().union(*(x for x in who.values() if len(x) > 1))


def test_sets_without_a_common_shingle_share_no_telling_cell():
    """However many there are: else unlike documents chain to one group at size."""
    assert not sharing(sets_of(np.random.default_rng(3), 4000, 60), 80)


def test_finer_cells_part_documents_that_share_a_passage():
    sets = sets_of(np.random.default_rng(4), 1500, 300, shared=20)
    assert len(sharing(sets, 80)) > 200
    assert len(sharing(sets, 80, True)) < 5


@pytest.mark.parametrize("percent", [50, 80, 90])
def test_linked_sets_share_a_finer_cell(percent):
    rng, seen = np.random.default_rng(6), 0
    for _ in range(600):
        n = int(rng.integers(3, 500))
        s = np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64))
        gone = int(rng.integers(0, n * (100 - percent) // 100 + 1))
        t = np.unique(np.concatenate([s[gone:], rng.integers(0, 1 << 63, int(rng.integers(0, gone + 1))).astype(np.uint64)]))
        k = len(np.intersect1d(s, t))
        if ngram_join.links(k, len(s), len(t), percent) and max(len(s), len(t)) != k:
            (ta, oa), (tb, ob) = ngram_join.cells(s, percent, True), ngram_join.cells(t, percent, True)
            assert set(ta.tolist()) & set(tb.tolist()) or set(oa) & set(ob)
            seen += 1
    assert seen > 200


def test_a_cell_takes_the_same_bytes_in_any_number_of_groups():
    """Sent with its node, it took three times as many at 1,000 groups as at 10."""
    rng = np.random.default_rng(5)
    nodes = [rng.bytes(16) for _ in range(1000)]
    found = [rng.integers(0, 1 << 63, 300).astype(np.uint64) for _ in nodes]
    for groups in (1, 10, 1000):
        rows = list(ngram_join._sent(nodes, found, groups))
        assert sum(len(r[2]) + len(r[3]) + len(r[4] or b"") for r in rows) <= 300_000 * 8 + 16_000
        assert [r[4] for r in rows if r[4] is not None] == [b"".join(nodes)] and len(rows) == groups + 1


def test_links_of_more_nodes_than_a_place_counts():
    """Batches of a group with over 65,536 nodes between them: the nodes of a
    cell are linked to one of them, and no others."""
    rng, rows, who = np.random.default_rng(9), [], defaultdict(set)
    for batch in range(5):
        label = rng.integers(0, 200_000, 30_000)
        for k, x in enumerate(label.tolist()):
            who[x].add((batch - 2, k))
        rows.append((batch - 2, np.arange(30_000, dtype=np.uint16).tobytes(), label.astype(np.uint64).view(np.uint8).reshape(-1, 8)[:, :ngram_join.LABEL_BYTES].tobytes()))
    got = defaultdict(set)
    for a, at, b, bt in zip(*(x.tolist() for x in ngram_join._meet(rows)), strict=True):
        got[b, bt].add((a, at))
    assert sorted(sorted(x | {head}) for head, x in got.items()) == sorted(sorted(x) for x in who.values() if len(x) > 1)


def test_ngram_small_batches_and_many_groups(spark, monkeypatch):
    pairs = chained_copies()
    monkeypatch.setattr(ngram_join, "CELL_GROUP", 40)
    monkeypatch.setattr(ngram_join, "SEND_CELLS", 100)
    got = records(ngram_join.ngram_components(frame(spark, pairs).repartition(3)))
    assert Counter(got) == Counter(jaccard_components(pairs))


def test_ngram_visitors_go_in_rounds(spark, monkeypatch):
    """The copies of a cut group's visitors are as many times as it has parts:
    they are dealt out in rounds that store no more than the group."""
    pairs, keep, seen = chained_copies(), ngram_join.materialise, []
    monkeypatch.setattr(ngram_join, "HEADS", 0)
    monkeypatch.setattr(ngram_join, "ROUND_BYTES", 1)

    def spy(df, name):
        seen.append(name)
        return keep(df, name)

    monkeypatch.setattr(ngram_join, "materialise", spy)
    docs = frame(spark, pairs).repartition(3)
    sets = keep(ngram_join.document_sets(docs, "doc_id", "text"), "sets")
    group = sets.select("node", F.lit(b"g").alias("component")).distinct()
    edges = ngram_join.verified_links(docs, sets, group, "doc_id", "text", part_rows=9)
    named = sets.select("doc_id", "node").join(ngram_join.connected_components(edges), "node", "left").select("doc_id", F.coalesce("component", "node").alias("c")).collect()
    least = {}
    for r in named:
        least[r.c] = min(least.get(r.c, r.doc_id), r.doc_id)
    assert seen.count("across") > 3
    assert sorted((r.doc_id, least[r.c]) for r in named) == sorted((i, c) for i, _, c in jaccard_components(pairs))


def test_ngram_empty_table(spark):
    assert ngram_join.ngram_components(frame(spark, [])).count() == 0


# --- substrings --------------------------------------------------------------

def substring_brute(pairs, width=20):
    docs = {}
    for i, t in pairs:
        docs.setdefault((last(i), t or ""), FIELDS.findall(t or ""))
    first = {}
    for key in sorted(docs, key=lambda k: k[0]):
        w = docs[key]
        for p in range(len(w) - width + 1):
            first.setdefault(tuple(w[p:p + width]), (key, p))
    out = []
    for i, t in pairs:
        key = (last(i), t or "")
        w, gone = docs[key], set()
        for p in range(len(w) - width + 1):
            if first[tuple(w[p:p + width])] != (key, p):
                gone |= set(range(p, p + width))
        out.append((i, len(w), len(gone), " ".join(x for p, x in enumerate(w) if p not in gone)))
    return out


@pytest.mark.parametrize("group_words", [4_000_000, 300])
def test_substring_removal(spark, group_words):
    pairs = rows()
    got = records(substring.remove_repeats(frame(spark, pairs).repartition(4), group_words=group_words))
    assert Counter(got) == Counter(substring_brute(pairs))


def test_substring_hot_passage(spark):
    import random
    rng = random.Random(5)
    passage = sentence(rng, 60)
    pairs = [(i, sentence(rng, 12) + " " + (passage if i % 3 == 0 else sentence(rng, 40)) + " tail") for i in range(300)]
    pairs += [(900, "la " * 400), (901, "la " * 30)]
    assert Counter(records(substring.remove_repeats(frame(spark, pairs).repartition(6), group_words=500))) == Counter(substring_brute(pairs))


def test_substring_empty_table(spark):
    assert substring.remove_repeats(frame(spark, [])).count() == 0


# --- lines -------------------------------------------------------------------

def line_brute(pairs, depth=3, support=2, similarity=0.7, min_docs=3, sparse_docs=10, long_tokens=20, long_docs=2):
    keys, docs = [], {}
    for i, t in pairs:
        docs[(last(i), t or "")] = (t or "").split("\n") if t else []
    for key, lines in docs.items():
        for k, line in enumerate(lines):
            own = FIELDS.findall(line)
            if own:
                keys.append((key, k, own, tuple("<*>" if re.search("[0-9]", x) else x for x in own)))
    patterns, count = {m for *_, m in keys}, Counter()
    for m in patterns:
        for p in range(depth, len(m)):
            if m[p] != "<*>":
                count[len(m), m[:depth], p, m[p]] += 1

    def templates(own, m):
        """(documents asked for, template) of a line."""
        g = [x if p < depth or count[len(m), m[:depth], p, x] >= support else "<*>" for p, x in enumerate(m)]
        n, constants = len(m), sum(x != "<*>" for x in m)
        exact = [(long_docs, ("equal", *own))] if n >= long_tokens else []
        if any(x != "<*>" for x in g[depth:]) and sum(x != "<*>" for x in g) >= similarity * n:
            return [(min_docs, ("g", *g)), *exact]
        if constants >= similarity * n:
            return [(min_docs, ("p", *m)), *exact]
        return [(min_docs, ("l", *own)), *exact, *[(sparse_docs, ("s", *m))][:constants]]

    where = defaultdict(list)
    for key, k, own, m in keys:
        for asked in templates(own, m):
            where[asked].append((key, k))
    gone = defaultdict(set)
    for (asked, _), places in where.items():
        if len({key for key, _ in places}) >= asked:
            for key, k in sorted(places)[1:]:
                gone[key].add(k)
    out = []
    for i, t in pairs:
        key = (last(i), t or "")
        out.append((i, len(docs[key]), len(gone[key]), "\n".join(x for k, x in enumerate(docs[key]) if k not in gone[key])))
    return out


def log_lines():
    import random
    rng = random.Random(4)
    pairs = []
    for i in range(40):
        lines = [sentence(rng, rng.randint(4, 12)) for _ in range(4)]
        lines.insert(1, f"Released under the terms of the {rng.choice(['red', 'blue', sentence(rng, 1)])} licence by its authors in {1990 + i}")
        lines.insert(3, f"page {i} of 40")
        if i % 3 == 0:
            lines += ["", "Subscribe to our  newsletter today", f"{i}", "the same"]
        pairs.append((i if i % 10 else None, "\n".join(lines)))
    return pairs + [(50, None), (51, ""), (52, "\n\n \t\n"), (53, "page 7 of 40"), (53, "page 7 of 40"), (54, "a " * 3000 + "\nthe same")]


def test_line_templates(spark):
    pairs = log_lines()
    got = records(line_dedup.drop_recurring_lines(frame(spark, pairs).repartition(3)))
    want = line_brute(pairs)
    assert Counter(r[:3] for r in got) == Counter(w[:3] for w in want)
    assert Counter(got) == Counter(want)
    dropped = {r[0]: r[2] for r in got}
    assert dropped[5] == 2  # the licence line, and "page 5 of 40", which is half fields but stands in 40 documents


def test_sparse_templates_and_long_equal_lines(spark):
    import random
    rng = random.Random(8)
    long, dated = sentence(rng, 24), sentence(rng, 21) + " 1999 " + sentence(rng, 3)
    pairs = [(i, f"{sentence(rng, 9)}\nchapter {i}") for i in range(9)]                 # nine documents: too few
    pairs += [(20 + i, f"{sentence(rng, 9)}\nitem {i}\n{i}") for i in range(10)]           # ten: recurs; numbers alone never do
    pairs += [(40, long), (41, f"own line here\n  {long.replace(' ', '   ')}"), (42, dated), (43, dated), (44, dated.replace("1999", "2001"))]
    pairs += [(50, sentence(rng, 19)), (52, sentence(rng, 24)), (None, None)]
    pairs += [(51, pairs[-3][1]), (52, pairs[-2][1])]                                   # 19 tokens twice; a repeated row
    want = line_brute(pairs)
    assert Counter(records(line_dedup.drop_recurring_lines(frame(spark, pairs).repartition(3)))) == Counter(want)
    gone = {w[0]: w[2] for w in want}
    assert [gone[i] for i in (0, 8, 20, 21, 29, 40, 41, 42, 43, 44, 50, 51, 52)] == [0, 0, 0, 1, 1, 0, 1, 0, 1, 1, 0, 0, 0]


def test_repeated_rows_make_no_token_constant(spark):
    """The only long lines of a leaf stand in rows that are there twice: they
    share no token, so none of them is a template."""
    words = "red orange yellow green blue indigo violet black".split()
    pairs = [(i if i else None, f"the error in {w}1 {w}a {w}b {w}c {w}d") for i, w in enumerate(words)]
    pairs += [(20 + i, f"one {w} line of its own\nthe error was shared by {w}x {w}y {w}z") for i, w in enumerate(words)]
    pairs = [p for p in pairs for _ in range(2)]
    want = line_brute(pairs)
    assert all(w[2] == 0 for w in want)
    assert Counter(records(line_dedup.drop_recurring_lines(frame(spark, pairs).repartition(3)))) == Counter(want)


def test_line_dedup_runs_no_python(spark):
    plan = line_dedup.drop_recurring_lines(frame(spark, log_lines()[:5]))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_line_dedup_empty_table(spark):
    assert line_dedup.drop_recurring_lines(frame(spark, [])).count() == 0


def test_rows_that_stay_whatever_the_other_columns_are_called(spark):
    from pyspark.sql import functions as F

    from metroflux.llm import exact_dedup, ngram_join
    words = " ".join(f"w{i}" for i in range(40))
    pairs = [(1, words), (1, words), (2, words), (3, None), (3, None), (4, ""), (None, words), (5, words + " more")]
    df = frame(spark, pairs).withColumn("__id", F.lit(7)).withColumn("row_key", F.lit(8)).withColumn("__key", F.lit(9)).withColumn("gone", F.lit(0))
    exact = exact_dedup.drop_exact_duplicates(df)
    assert exact.columns == df.columns and sorted((r.doc_id, r.text) for r in exact.collect() if r.text) == [(1, words), (5, words + " more")]
    assert sorted(r.doc_id for r in exact.collect() if not r.text) == [3]
    near = ngram_join.drop_near_duplicates(df, width=5, percent=80)
    assert near.columns == df.columns and sorted(r.doc_id for r in near.collect() if r.text) == [1]
    assert sorted(r.doc_id for r in near.collect() if not r.text) == [3, 3, 4]
    for f in (exact_dedup.drop_exact_duplicates, ngram_join.drop_near_duplicates):
        assert f(df.limit(0)).collect() == []


def test_what_dedup_stores_on_the_way_goes(spark):
    """Only the names of rows that go are left, and no query's shuffle files."""
    from metroflux.llm.common import CLEANUP, materialise, scratch
    from metroflux.session import shared_dir
    folder = shared_dir(spark, "llm")
    df = frame(spark, [(1, "a b c d e f g"), (2, "a b c d e f g"), (3, "h i j k l m n"), (3, "h i j k l m n"), (4, "o p q r s t u")])
    for f in (exact_dedup.drop_exact_duplicates, ngram_join.drop_near_duplicates):
        before = set(os.listdir(folder))
        out = f(df)
        assert sorted(r.doc_id for r in out.collect()) == [1, 3, 4]
        assert {x.split("-")[0] for x in set(os.listdir(folder)) - before} <= {"gone", "repeated"}
    manager = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    shuffles = lambda: {x for x in str(manager.getAllFiles().mkString(" ")).split() if "/shuffle_" in x}
    old = shuffles()
    with scratch() as keep:
        a = materialise(spark.range(1000).repartition(7), "a")
        b = keep(materialise(a.groupBy((a.id % 5).alias("k")).count(), "b"))
    for _ in range(50):
        if not shuffles() - old:
            break
        time.sleep(0.2)
    assert not shuffles() - old and spark.conf.get(CLEANUP) == "false"
    assert not os.path.exists(a.stored_path) and b.count() == 5


def test_near_duplicate_rule_of_the_pipeline(spark):
    """Ten of 500 words changed: five-word similarity above 0.8, three-word below 0.9."""
    import corpus_pipeline
    from metroflux.llm import ngram_join
    a = [f"w{i}" for i in range(500)]
    b = list(a)
    for i in range(10):
        b[50 * i + 20] = f"x{i}"
    df = frame(spark, [(1, " ".join(a)), (2, " ".join(b)), (3, " ".join(reversed(a)))])
    assert sorted(r.doc_id for r in ngram_join.drop_near_duplicates(df).collect()) == [1, 2, 3]
    assert sorted(r.doc_id for r in corpus_pipeline.drop_near_duplicates(spark, df, "").collect()) == [1, 3]


def test_substring_dedup_of_rows_without_an_id(spark):
    """Two texts of one 32-bit hash, both without an id."""
    from pyspark.sql import functions as F

    from metroflux.llm import substring
    base = " ".join(f"a{i}" for i in range(30))
    found, n = {}, 0
    while True:
        part = [f"{base} t{j} {'z ' * (j % 9)}".strip() for j in range(n, n + 40_000)]
        n += len(part)
        hashes = spark.createDataFrame([(t,) for t in part], "t string").select("t", F.hash("t").alias("h")).collect()
        twice = next(((found[h], t) for t, h in hashes if h in found and len(found[h].split()) != len(t.split()) or found.setdefault(h, t) != t), None)
        if twice:
            break
    out = substring.remove_repeats(frame(spark, [(None, twice[0]), (None, twice[1])])).collect()
    assert sorted((r.n_words - r.n_removed) for r in out) != [] and sum(r.n_removed for r in out) == 30
    with pytest.raises(TypeError, match="integer"):
        substring.remove_repeats(spark.createDataFrame([("a", "b")], "doc_id string, text string"))


@pytest.mark.parametrize("percent", [80, 90])
def test_linked_sets_share_a_cell(percent):
    rng = np.random.default_rng(0)
    seen = 0
    for _ in range(1500):
        n = int(rng.integers(5, 400))
        base = rng.integers(0, 2**63, n).astype(np.uint64)
        other = base.copy()
        k = int(rng.integers(0, max(1, n // 7) + 1))
        other[:k] = rng.integers(0, 2**63, k)
        a, b = np.unique(base), np.unique(other[int(rng.integers(0, max(1, n // 8))):])
        if ngram_join.links(len(np.intersect1d(a, b)), len(a), len(b), percent) and ngram_join.node_of(a) != ngram_join.node_of(b):
            (ta, oa), (tb, ob) = ngram_join.cells(a, percent), ngram_join.cells(b, percent)
            assert set(ta.tolist()) & set(tb.tolist()) or set(oa) & set(ob)
            seen += 1
    assert seen > 200


@pytest.mark.parametrize("marks", [1, 1 << 18])
def test_rows_that_stay_for_sure_are_not_shuffled(spark, monkeypatch, marks):
    monkeypatch.setattr(common, "MARKS", marks)
    pairs = [(i, f"text {i}") for i in range(2000)] + [(None, "none"), (None, "other"), (7, "another text of 7"), (8, "text 8")]
    docs = frame(spark, pairs)
    key = F.col("text")
    gone = spark.createDataFrame([(i, f"text {i}") for i in range(0, 2000, 100)] + [(7, "text 7"), (None, "none")], "doc_id long, key string")
    kept = common.keep_rows(docs, "doc_id", key, gone, spark.createDataFrame([(8, "text 8")], "doc_id long, key string"))
    named = {tuple(r) for r in gone.collect()}
    assert kept.columns == docs.columns
    assert Counter((r.doc_id, r.text) for r in kept.collect()) == Counter(dict.fromkeys((p for p in pairs if p not in named), 1))
    stay, may_go = common._by_marks(docs, "doc_id", gone)
    assert stay.count() + may_go.count() == len(pairs)
    assert {i for i, _ in named} <= {r.doc_id for r in may_go.collect()}
    assert marks == 1 or may_go.count() < 40
