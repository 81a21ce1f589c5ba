"""Decontamination, WARC, sharding and BPE against brute force, round trips
and laws."""

import base64
import gzip
import hashlib
import io
import os
import random
import re
import tempfile
import zlib
from collections import Counter, defaultdict

import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from metroflux.llm import bpe, decontaminate, sharding, warc
from tests.llm.fixtures import frame, records, rows, sentence

# --- decontamination ---------------------------------------------------------

TERM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))


def contamination_brute(docs, items, width=13):
    windows = defaultdict(set)
    for item, text in items:
        w = terms(text)
        n = min(width, len(w))
        for i in range(len(w) - n + 1 if n else 0):
            windows[tuple(w[i:i + n])].add(item)
    out = []
    for doc, text in docs:
        w, hit, found = terms(text), set(), set()
        for n in {len(x) for x in windows}:
            for i in range(len(w) - n + 1):
                if tuple(w[i:i + n]) in windows:
                    hit |= set(range(i, i + n))
                    found |= windows[tuple(w[i:i + n])]
        names = sorted(str(x) for x in found if x is not None)
        out.append((doc, len(w), len(hit), len(names), hashlib.sha256(",".join(names).encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(w)))
    return out


def benchmark_case():
    rng = random.Random(9)
    items = [(i, sentence(rng, rng.randint(5, 40))) for i in range(25)]
    items += [(100, items[0][1]), (0, items[0][1]), (101, None), (102, ""), (103, "sota"), (None, items[1][1]), (104, "?!")]
    docs = rows(3, 30)
    for i, t in items[:12]:
        docs.append((2000 + i, sentence(rng, 10) + " " + (t or "").upper().replace(" ", "-", 2) + " " + sentence(rng, 300 if i % 2 else 5)))
    docs.append((3000, " ".join(t for _, t in items[:8])))
    return docs, items


@pytest.mark.parametrize("slice_words", [2_000_000, 150])
def test_contamination(spark, slice_words):
    docs, items = benchmark_case()
    bench = spark.createDataFrame([(i, t, 0) for i, t in items], "item_id long, text string, block int")
    got = records(decontaminate.contamination(frame(spark, docs).repartition(3), bench, slice_words=slice_words).drop("spans"))
    assert Counter(got) == Counter(contamination_brute(docs, items))


def test_contamination_with_empty_tables(spark):
    empty = spark.createDataFrame([], "item_id long, text string")
    docs = rows(3, 6)
    assert not any(r[2] for r in records(decontaminate.contamination(frame(spark, docs), empty)))
    bench = spark.createDataFrame([(1, "a b c")], "item_id long, text string")
    assert decontaminate.contamination(frame(spark, []), bench).count() == 0


def test_proximity_matches(spark):
    docs = [(1, "aa xx bb yy cc"), (2, "aa bb cc"), (3, "aa xx xx xx bb cc"), (4, "cc bb")]
    windows = next(decontaminate.benchmark_slices(spark.createDataFrame([(7, "aa bb cc")], "item_id long, text string")))
    index = decontaminate.build_index(frame(spark, docs).coalesce(1), windows.terms)

    def found(slop):
        return {r.doc for r in decontaminate.search(index, windows, slop).collect()}

    assert found(0) == {1} and found(2) == {0, 1}  # numbers in the block


def test_hit_spans(spark):
    bench = spark.createDataFrame([(7, "aa bb cc")], "item_id long, text string")
    got = decontaminate.contamination(frame(spark, [(1, "x aa bb cc aa bb cc y aa bb cc")]), bench).collect()[0]
    assert got.n_hit == 9 and [list(s) for s in got.spans] == [[1, 4], [4, 7], [8, 11]] or [list(s) for s in got.spans] == [[1, 7], [8, 11]]


def test_drop_contaminated(spark):
    docs, items = benchmark_case()
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = Counter(w[0] for w in contamination_brute(docs, items) if not w[5])
    assert Counter(r[0] for r in records(decontaminate.drop_contaminated(frame(spark, docs), bench))) == want


# --- WARC --------------------------------------------------------------------

def page_rows():
    same, rng = "<p>" + "copy é " * 300 + "</p>", random.Random(2)
    pages = [(i, f"http://h/{i}", f"<html>{sentence(rng, 50)}</html>") for i in range(30)]
    pages += [(100 + i, "http://h/ä b\r\nX: y", same) for i in range(5)]
    return pages + [(200, None, "short"), (201, "u", "short"), (202, "u", None), (203, "u", ""), (104, "again", same), (None, "u", same), (204, "u", "z" * 3_000_000)]


def page_frame(spark, pages):
    return spark.createDataFrame([(*p, 1) for p in pages], "page_id long, url string, html string, digest int")


def test_warc_round_trip(spark):
    pages = page_rows()
    largest = {}
    for i, _, h in pages:
        if h and len(h.encode()) >= 1000 and i is not None:
            largest[h] = max(i, largest.get(h, i))
    want = []
    for i, _, h in pages:
        data, top = (h or "").encode(), largest.get(h)
        revisit = top is not None and i != top
        want.append((i, len(data), hashlib.sha1(data).hexdigest(), "revisit" if revisit else "response", top if revisit else None))
    assert Counter(records(warc.round_trip(page_frame(spark, pages).repartition(3)))) == Counter(want)


def test_warc_files_hold_one_member_per_record_and_payloads(spark):
    pages = page_rows()
    path = tempfile.mkdtemp(prefix="warc-")
    manifest = warc.write_archives(page_frame(spark, pages).repartition(2), path, file_bytes=4000)
    assert manifest.count() > 2
    back = {r.page_id: r for r in warc.read_archives(manifest, path).collect()}
    assert bytes(back["204"].payload) == b"z" * 3_000_000 and back["204"].url == "u" and back["200"].url is None
    assert "\n" not in back["100"].url and back["100"].payload is None and back["100"].refers_to == "104"
    for r in manifest.collect():
        data, members = open(r.file, "rb").read(), 0
        assert gzip.decompress(data).count(b"WARC/1.1\r\n") == r.records + 1  # and a warcinfo record
        while data:
            z = zlib.decompressobj(31)
            z.decompress(data)
            data, members = z.unused_data, members + 1
        assert members == r.records + 1


def test_warc_reader_rejects_damage():
    one = warc.page_record(1, "u", b"x" * 2000, hashlib.sha1(b"x" * 2000).hexdigest(), None, "2024-01-01T00:00:00Z")
    assert [h["warc-page-id"] for _, h, _ in warc.read_records(io.BytesIO(one + one))] == ["1", "1"]
    plain = gzip.decompress(one)
    short, other = plain.replace(b"Content-Length: 2", b"Content-Length: 1", 1), plain.replace(b"xxxx", b"xxxy", 1)
    for bad in (one[:-5], one[:40], b"junk" + one, gzip.compress(other), gzip.compress(plain[:-2]), gzip.compress(b"no header"), gzip.compress(short)):
        with pytest.raises(warc.DamagedArchive):
            list(warc.read_records(io.BytesIO(bad)))


def test_warc_reader_inflates_in_small_chunks(monkeypatch):
    monkeypatch.setattr(warc, "CHUNK", 7)
    members = b"".join(warc.page_record(i, "u", os.urandom(50), "00" * 20, None, "d") for i in range(3))
    assert [int(h["warc-page-id"]) for _, h, _ in warc.read_records(io.BytesIO(members))] == [0, 1, 2]


def test_warc_empty_table(spark):
    assert warc.round_trip(page_frame(spark, [])).count() == 0


# --- sharding ----------------------------------------------------------------

@pytest.mark.parametrize("law", ["bytes", "rows", "key"])
def test_sharding_laws(spark, law):
    pairs = rows(1, 90) + [(77, "hot copy of some text")] * 150
    got = records(sharding.shard(frame(spark, pairs).repartition(5), 7, law, range_rows=20))
    want = Counter((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in pairs)
    assert Counter(r[:3] for r in got) == want and {r[3] for r in got} == {law}
    by = defaultdict(list)
    for r in got:
        by[r[4]].append(r)
    for members in by.values():
        assert sorted(r[5] for r in members) == list(range(len(members)))
    assert set(by) <= set(range(7))
    if law == "rows":
        n = [len(by[s]) for s in range(7)]
        assert max(n) - min(n) <= 1
    if law == "bytes":
        total, most = sum(r[1] for r in got), max(r[1] for r in got)
        assert all(abs(sum(r[1] for r in by[s]) - total / 7) <= most for s in range(7))
    if law == "key":
        assert all(r[6] in (r[4], 7) for r in got) and len({(r[0], r[4]) for r in got}) == len({r[0] for r in got})
        larger = {r[0]: r[4] for r in records(sharding.shard(frame(spark, pairs), 8, law))}
        assert all(larger[r[0]] == r[6] for r in got)
    else:
        assert all(r[6] is None for r in got)


def test_overfull_ranges_are_subdivided(spark):
    df = spark.range(4000).selectExpr("0L as last", "5L as id", "1L as crc", "id as row", "if(id < 3000, 1L, 50L) as size")
    cuts = sharding.splitters(df, 3000 + 50_000, 4000, 4, 100)
    share = 53_000 / 40
    sizes = df.withColumn("range", sharding.range_of(cuts)).groupBy("range").sum("size").collect()
    assert all(r[1] <= 2 * share for r in sizes) and cuts == sorted(cuts)


def test_sharding_runs_no_python(spark):
    plan = sharding.shard(frame(spark, rows(1, 10)))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_sharding_empty_table_and_files(spark):
    assert sharding.shard(frame(spark, [])).count() == 0
    path = tempfile.mkdtemp(prefix="shards-") + "/out"
    pairs = rows(1, 20)
    sharding.write_shards(frame(spark, pairs), path, 3)
    back = spark.read.parquet(path)
    assert Counter((r.doc_id, r.text) for r in back.collect()) == Counter(pairs) and back.select("shard").distinct().count() == 3


# --- BPE ---------------------------------------------------------------------

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def reference():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_bpe_matches_the_library(spark, reference):
    pairs = rows() + [(20, "<|endoftext|>"), (21, "a" * 500 + "!" * 77), (22, "don't WE'LL  \n\n\t x1²3"), (23, "日本語😀" * 20)]
    want = Counter()
    for i, t in pairs:
        ids = reference.encode_ordinary(t or "")
        want[i, len(ids), hashlib.sha256(b"".join(x.to_bytes(4, "little") for x in ids)).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()] += 1
    assert Counter(records(bpe.round_trip(frame(spark, pairs).repartition(3), PATH, public_tokenizers.PATTERN, block_chars=2000))) == want


def test_bpe_encode_and_decode_tables(spark, reference):
    pairs = rows(2, 12)
    encoded = bpe.encode(frame(spark, pairs), PATH, public_tokenizers.PATTERN)
    assert Counter((i, tuple(ids)) for i, ids in records(encoded)) == Counter((i, tuple(reference.encode_ordinary(t or ""))) for i, t in pairs)
    assert Counter((i, bytes(t)) for i, t in records(bpe.decode(encoded, PATH, public_tokenizers.PATTERN))) == Counter((i, (t or "").encode()) for i, t in pairs)
    assert bpe.round_trip(frame(spark, []), PATH, public_tokenizers.PATTERN).count() == 0


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from("aábth eion'sl1² \n!日😀"), max_size=60), min_size=1, max_size=4))
def test_bpe_replay_is_exact(texts):
    model, ref = bpe.model(PATH, public_tokenizers.PATTERN), _REF[0]
    assert [x.tolist() for x in model.encode(texts)] == [ref.encode_ordinary(t) for t in texts]


_REF = [tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, special_tokens={},
                          mergeable_ranks={base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))})]


def test_bpe_lower_rank_after_a_merge_comes_first(tmp_path):
    """Vocabularies where a merge opens a pair of a lower rank."""
    tokens = [bytes([i]) for i in range(256)] + [b"abc", b"bc", b"cc", b"abcabc", b"ca"]
    path = tmp_path / "v.tiktoken"
    path.write_bytes(b"\n".join(base64.b64encode(t) + b" " + str(i).encode() for i, t in enumerate(tokens)))
    model = bpe.Model(str(path), r"\S+|\s+")
    ref = tiktoken.Encoding("v", pat_str=r"\S+|\s+", mergeable_ranks={t: i for i, t in enumerate(tokens)}, special_tokens={})
    rng = random.Random(0)
    for _ in range(300):
        text = " ".join("".join(rng.choice("abc") for _ in range(rng.randint(1, 14))) for _ in range(4))
        assert next(model.encode([text])).tolist() == ref.encode_ordinary(text), text
