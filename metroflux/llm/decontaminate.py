"""Benchmark decontamination over a distributed positional inverted index.

The corpus is cut in blocks of documents; ``build_index`` stores, for each
block, the positions of every benchmark term in it (term, sorted positions)
next to the documents' word offsets.  ``search`` takes each benchmark
window's rarest term of the block, subtracts its offset from the postings,
and intersects the offset-adjusted lists of the other terms from rare to
common; only starts that survive all terms inside one document are matches.
With ``slop`` > 0 a term may stand up to that many words from its place
(proximity matches).  Building and searching need no shuffle, and a hot term
or passage is spread over all blocks that hold it.

The benchmark is broadcast in slices of at most ``SLICE_WORDS`` words (one
pass over the corpus each); long items are cut in overlapping chunks first.

Words: A-Z lower-cased, ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+``, whole texts,
as 64-bit hashes.  A window is 13 consecutive words of an item; a shorter
item (with words) is one window.

Defined cases: a null or empty text has no words and is never hit; an empty
benchmark hits nothing; repeated documents each get their own row; repeated
items with one id count once; an item with a null id marks words as hit but
is not listed; extra columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from metroflux.llm.common import ALNUM_WORDS, materialise, ranges, scratch, text_blocks, unused, word_hashes

WINDOW = 13
SLICE_WORDS = 2_000_000
CHUNK = 50_000


class Windows:
    """The distinct windows of a benchmark slice: word hashes by place
    (``length`` of them count) and the items that hold each."""

    def __init__(self, chunks: list[tuple[str | None, np.ndarray]], width: int = WINDOW):
        rows, lengths, items = [], [], []
        for item, words in chunks:
            n = min(width, len(words))
            if n:
                w = np.lib.stride_tricks.sliding_window_view(words, n)
                rows.append(np.pad(w, ((0, 0), (0, width - n))))
                lengths += [n] * len(w)
                items += [item] * len(w)
        self.width = width
        if not rows:
            self.words, self.length = np.zeros((0, width), np.uint64), np.zeros(0, np.int64)
            self.items: list[list[str]] = []
        else:
            table = np.concatenate([np.concatenate(rows), np.array(lengths, dtype=np.uint64)[:, None]], axis=1)
            distinct, of = np.unique(table, axis=0, return_inverse=True)
            self.words, self.length = distinct[:, :width], distinct[:, width].astype(np.int64)
            held: list[set[str]] = [set() for _ in range(len(distinct))]
            for w, item in zip(of.ravel().tolist(), items, strict=True):
                if item is not None:
                    held[w].add(item)
            self.items = [sorted(h) for h in held]
        inside = np.arange(width) < self.length[:, None]
        self.terms = np.unique(self.words[inside])

    def term_numbers(self) -> np.ndarray:
        return np.searchsorted(self.terms, self.words)


def benchmark_slices(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text", width: int = WINDOW,
                     slice_words: int = SLICE_WORDS) -> Iterator[Windows]:
    """The benchmark's windows, in slices of about ``slice_words`` words."""

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, out = b.column(0).to_pylist(), ([], [])
            for i, j, data, offsets in text_blocks(b.column(1)):
                h, _, _, first = word_hashes(data, offsets, ALNUM_WORDS)
                for r in range(i, j):
                    words = h[first[r - i]:first[r - i + 1]]
                    for k in range(0, max(len(words) - width + 1, min(len(words), 1)), CHUNK):
                        out[0].append(ids[r])
                        out[1].append(words[k:k + CHUNK + width - 1].tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.string()), pa.array(out[1], pa.binary())], ["item", "words"])

    cut = materialise(benchmark.select(F.col(id_col).cast("string"), F.col(text_col).cast("string")).mapInArrow(chunks, "item string, words binary"), "benchmark")
    total = cut.agg(F.sum(F.octet_length("words")) / 8).first()[0] or 0
    n = int(total // slice_words) + 1
    for k in range(n):
        part = cut if n == 1 else cut.where(F.pmod(F.xxhash64("item", "words"), F.lit(n)) == k)
        yield Windows([(r.item, np.frombuffer(r.words, np.uint64)) for r in part.collect()], width)  # one bounded slice


def build_index(docs: DataFrame, terms: np.ndarray, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per block: its documents (ids, hashes of id and text, word
    offsets) and the postings of ``terms`` (term number -> sorted word
    positions in the block)."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(terms)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms = shared.value
        maybe = np.zeros(1 << 20, dtype=bool)
        maybe[terms >> np.uint64(44)] = True
        block = TaskContext.get().partitionId() << 32
        for b in batches:
            for i, j, data, offsets in text_blocks(b.column(1)):
                h, _, _, first = word_hashes(data, offsets, ALNUM_WORDS)
                at = np.flatnonzero(maybe[h >> np.uint64(44)])
                number = np.searchsorted(terms, h[at])
                hit = terms[np.minimum(number, max(len(terms) - 1, 0))] == h[at] if len(terms) else np.zeros(0, dtype=bool)
                at, number = at[hit], number[hit]
                order = np.argsort(number, kind="stable")
                at, number = at[order], number[order]
                present, start = np.unique(number, return_index=True)
                gaps = np.diff(at, prepend=0)
                gaps[start] = at[start]
                row = [pa.array([block]), *[pa.ListArray.from_arrays(pa.array([0, j - i], pa.int32()), b.column(c).slice(i, j - i)) for c in (0, 2)],
                       pa.array([first.astype(np.int32).tolist()], pa.list_(pa.int32()))]
                row += [pa.array([x.astype(np.int32).tobytes()], pa.binary()) for x in (present, np.append(start, len(at)), gaps)]
                yield pa.RecordBatch.from_arrays(row, ["block", "ids", "keys", "first", "terms", "starts", "gaps"])
                block += 1

    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"block long, ids array<{kind}>, keys array<long>, first array<int>, terms binary, starts binary, gaps binary"
    return docs.select(docs[id_col], docs[text_col].cast("string"), F.xxhash64(id_col, text_col).alias("key")).mapInArrow(run, schema)


def find(windows: Windows, numbers: np.ndarray, present: np.ndarray, starts: np.ndarray, positions: np.ndarray,
         first: np.ndarray, slop: int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(window, start, document) of every match in one block: rarest term
    first, then the offset-adjusted lists of the others from rare to common."""
    width, n_words = windows.width, int(first[-1])
    empty = np.zeros(0, dtype=np.int64)
    if not len(present) or not len(windows.length):
        return empty, empty, empty
    local = np.minimum(np.searchsorted(present, numbers), len(present) - 1)
    have = present[local] == numbers
    inside = np.arange(width) < windows.length[:, None]
    w = np.flatnonzero((have | ~inside).all(axis=1))
    if not len(w):
        return empty, empty, empty
    size = np.diff(starts)
    count = np.where(inside[w], size[local[w]], np.iinfo(np.int64).max)
    order = np.argsort(count, axis=1, kind="stable")
    span = n_words + 2 * width + 2 * slop + 2
    keys = np.repeat(np.arange(len(present), dtype=np.int64), size) * span + positions + width + slop
    rows = np.arange(len(w))
    lead = order[:, 0]
    term = local[w, lead]
    who = np.repeat(rows, size[term])
    at = positions[ranges(starts[:-1][term], size[term])] - lead[who]
    fits = (at >= 0) & (at + windows.length[w[who]] <= n_words)
    who, at = who[fits], at[fits]
    doc = np.searchsorted(first, at, side="right") - 1
    fits = at + windows.length[w[who]] <= first[doc + 1]
    who, at, doc = who[fits], at[fits], doc[fits]
    for k in range(1, width):
        if not len(who):
            break
        place = order[who, k]
        used = place < windows.length[w[who]]
        key = local[w[who], place].astype(np.int64) * span + at + place + width + slop
        near = np.searchsorted(keys, key - slop)
        ok = (keys[np.minimum(near, len(keys) - 1)] <= key + slop) & (near < len(keys)) | ~used
        who, at, doc = who[ok], at[ok], doc[ok]
    return w[who], at, doc


def search(index: DataFrame, windows: Windows, slop: int = 0) -> DataFrame:
    """One row per document with matches: id, key, doc (its number in the
    block), items (ids of the items with occurring windows), spans (int32
    pairs: first word and end of every matched stretch, document-relative)."""
    shared = index.sparkSession.sparkContext.broadcast(windows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows = shared.value
        numbers = windows.term_numbers()
        for b in batches:
            for r in b.to_pylist():
                present, starts, gaps = (np.frombuffer(r[c], np.int32).astype(np.int64) for c in ("terms", "starts", "gaps"))
                total = np.cumsum(gaps)
                size = np.diff(starts)
                base = total[starts[:-1]] - gaps[starts[:-1]] if len(size) else total
                positions = total - np.repeat(base, size)
                first = np.array(r["first"], dtype=np.int64)
                w, at, doc = find(windows, numbers, present, starts, positions, first, slop)
                order = np.lexsort((at, doc))
                w, at, doc = w[order], at[order], doc[order]
                out = ([], [], [], [], [])
                for d, lo, hi in zip(*_groups(doc), strict=True):
                    start, end = at[lo:hi] - first[d], at[lo:hi] - first[d] + windows.length[w[lo:hi]]
                    row = (r["ids"][d], r["keys"][d], d, sorted({i for x in np.unique(w[lo:hi]).tolist() for i in windows.items[x]}),
                           union(np.stack([start, end], axis=1)).astype(np.int32).tobytes())
                    for to, x in zip(out, row, strict=True):
                        to.append(x)
                kinds = [b.schema.field("ids").type.value_type, pa.int64(), pa.int32(), pa.list_(pa.string()), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(out, kinds, strict=True)], ["id", "key", "doc", "items", "spans"])

    kind = index.schema["ids"].dataType.elementType.simpleString()
    return index.select("ids", "keys", "first", "terms", "starts", "gaps").mapInArrow(run, f"id {kind}, key long, doc int, items array<string>, spans binary")


def _groups(sorted_values: np.ndarray) -> tuple[list[int], list[int], list[int]]:
    value, lo = np.unique(sorted_values, return_index=True)
    return value.tolist(), lo.tolist(), [*lo.tolist(), len(sorted_values)][1:len(lo) + 1]


def union(spans: np.ndarray) -> np.ndarray:
    """Disjoint spans that cover the same words."""
    spans = spans[np.argsort(spans[:, 0], kind="stable")]
    reach = np.maximum.accumulate(spans[:, 1])
    new = np.concatenate([[True], spans[1:, 0] > reach[:-1]])
    ends = np.append(np.flatnonzero(new)[1:] - 1, len(spans) - 1)
    return np.stack([spans[new, 0], reach[ends]], axis=1)


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  slice_words: int = SLICE_WORDS) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, n_items, items_sha256,
    contaminated, and spans (the hit stretches, word numbers)."""
    index, found = None, []
    for windows in benchmark_slices(benchmark, slice_words=slice_words):
        index = materialise(build_index(docs, windows.terms, id_col, text_col), "postings")
        found.append(search(index, windows))

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = ([], [], [], [])
            for items, spans in zip(b.column(2).to_pylist(), b.column(3).to_pylist(), strict=True):
                names = sorted({i for part in items for i in part})
                both = union(np.concatenate([np.frombuffer(s, np.int32).reshape(-1, 2) for s in spans]))
                out[0].append(int((both[:, 1] - both[:, 0]).sum()))
                out[1].append(len(names))
                out[2].append(hashlib.sha256(",".join(names).encode()).hexdigest())
                out[3].append(both.tolist())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.string()),
                                              pa.array(out[3], pa.list_(pa.list_(pa.int32())))], ["id", "key", "n_hit", "n_items", "items_sha256", "spans"])

    kind = docs.schema[id_col].dataType.simpleString()
    hits = (reduce(DataFrame.unionByName, found).groupBy("id", "key").agg(F.collect_list("items").alias("items"), F.collect_list("spans").alias("spans"))
            .mapInArrow(merge, f"id {kind}, key long, n_hit long, n_items long, items_sha256 string, spans array<array<int>>"))
    rows = index.select(F.explode(F.arrays_zip("ids", "keys", F.slice("first", 1, F.size("ids")).alias("lo"), F.slice("first", 2, F.size("ids")).alias("hi"))).alias("d"))
    n_hit, n_words = F.coalesce("n_hit", F.lit(0)), (F.col("d.hi") - F.col("d.lo")).cast("long")
    return rows.join(hits, F.col("d.ids").eqNullSafe(F.col("id")) & (F.col("d.keys") == F.col("key")), "left").select(
        F.col("d.ids").alias("doc_id"), n_words.alias("n_words"), n_hit.alias("n_hit"), F.coalesce("n_items", F.lit(0)).alias("n_items"),
        F.coalesce("items_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("items_sha256"),
        ((n_hit > 0) & (20 * n_hit >= n_words)).alias("contaminated"), "spans")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, that are not contaminated."""
    name = unused(docs, "row_key")
    keyed = docs.withColumn(name, F.xxhash64(F.col(id_col), F.col(text_col)))
    with scratch() as keep:
        gone = keep(materialise(contamination(keyed, benchmark, name, text_col).where("contaminated").select(F.col("doc_id").alias("gone")).distinct(), "gone"))
    return keyed.join(gone, keyed[name] == gone["gone"], "left_anti").drop(name)


ORACLE = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bw AS (SELECT DISTINCT item_id, least(13, len(w)) AS n, array_to_string(w[i:i + least(13, len(w)) - 1], ' ') AS s
       FROM (SELECT *, unnest(generate_series(1, greatest(1, len(w) - 12))) AS i FROM b WHERE len(w) > 0)),
lens AS (SELECT DISTINCT n FROM bw),
dw AS (SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS s
       FROM (SELECT d.*, n, unnest(generate_series(1, len(w) - n + 1)) AS i FROM d, lens WHERE len(w) >= n)),
m AS (SELECT doc_id, item_id, i, dw.n FROM dw JOIN bw USING (n, s)),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(generate_series(i, i + n - 1)) AS p FROM m) GROUP BY doc_id),
it AS (SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM m) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN it USING (doc_id)
"""
