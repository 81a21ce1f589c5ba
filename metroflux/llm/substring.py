"""Substring deduplication with prefix-partitioned suffix trees.

A window is ``width`` consecutive words of one document; a word is removed
if it is covered by a window whose word sequence also starts earlier
(smaller doc_id, or the same document and an earlier start).

1. One pass counts words (in hash bins) over the whole corpus.  The prefix
   of a suffix is its words up to and including the first one whose bin
   stays under ``GROUP_WORDS``, at most ``width``: rare words make short
   prefixes, frequent ones long prefixes, so no prefix holds more suffixes
   than fit in a group, and prefixes are dealt to groups by hash.
2. Each map task takes blocks of documents, keeps the earliest suffix of
   every distinct window of a block (the others are repeats already), and
   ships (window label, document, start) to the prefix's group: however
   often a passage occurs, a block sends it once.
3. A group sorts its labels.  Of the subtree only the nodes of depth
   ``width`` matter: labels of equal windows are one node, and every leaf
   below it but the earliest is a repeat.
4. Repeats return to their documents, which are rebuilt whole.

Labels are 64-bit hashes of the window, compared only inside one prefix
group.

Defined cases: a null text has no words; ids are integers, a null id comes
after all others; rows with equal id and text are one document (each row is
returned, with the same result); rows with equal id and different texts are
ordered by a text hash; an empty table gives an empty result; extra columns
are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from metroflux.llm.common import _Q, RAW_WORDS, _power_table, mix, ranges, text_blocks, word_hashes

WIDTH = 20
GROUP_WORDS = 2_000_000
BIN_BITS = 14
_LAST = np.iinfo(np.int64).max
_SUFFIXES = "grp int, docs binary, hashes binary, counts binary, gaps binary, labels binary"


def _pack(a: np.ndarray, dtype) -> bytes:
    return zlib.compress(a.astype(dtype).tobytes(), 1)


def _unpack(b: bytes, dtype) -> np.ndarray:
    return np.frombuffer(zlib.decompress(b), dtype=dtype)


def pack_starts(doc: np.ndarray, start: np.ndarray, ids: np.ndarray, hashes: np.ndarray) -> tuple[bytes, bytes, bytes, bytes]:
    """Runs of window starts, ordered by (document number, start)."""
    head = np.flatnonzero(np.diff(doc, prepend=-1))
    gaps = np.diff(start, prepend=0)
    gaps[head] = start[head]
    d = doc[head]
    return (_pack(ids[d], np.int64), hashes[d].astype(np.int64).tobytes(), _pack(np.diff(np.append(head, len(doc))), np.int32), _pack(gaps, np.int32))


def unpack_starts(docs: bytes, hashes: bytes, counts: bytes, gaps: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(ids, hashes, counts) of the documents and all starts."""
    count, gap = _unpack(counts, np.int32).astype(np.int64), _unpack(gaps, np.int32).astype(np.int64)
    total = np.cumsum(gap)
    head = np.cumsum(count) - count
    return _unpack(docs, np.int64), np.frombuffer(hashes, np.int64), count, total - np.repeat(total[head] - gap[head], count)


def word_counts(docs: DataFrame) -> np.ndarray:
    """Words of the corpus by hash bin (a table of fixed size)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << BIN_BITS, dtype=np.int64)
        for b in batches:
            for _, _, data, offsets in text_blocks(b.column(0)):
                h = word_hashes(data, offsets, RAW_WORDS)[0]
                total += np.bincount((h >> np.uint64(64 - BIN_BITS)).astype(np.int64), minlength=1 << BIN_BITS)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(total[used])], ["bin", "n"])

    bins = docs.select("text").mapInArrow(run, "bin int, n long").groupBy("bin").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros(1 << BIN_BITS, dtype=np.int64)
    for r in bins:
        counts[r.bin] = r.n
    return counts


def prefix_hashes(h: np.ndarray, frequent: np.ndarray, width: int) -> np.ndarray:
    """Hash of every suffix's variable-length prefix."""
    n = len(h)
    here = np.where(frequent[(h >> np.uint64(64 - BIN_BITS)).astype(np.int64)], n, np.arange(n))
    end = np.minimum(np.minimum.accumulate(here[::-1])[::-1] + 1, np.arange(n) + width)
    power, inverse = _power_table(_Q, n + 1)
    total = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(h * power[:n], out=total[1:])
    return mix(mix((total[np.minimum(end, n)] - total[:-1]) * inverse[:n]) ^ np.uint64(0x2545F4914F6CDD1D))


def block_suffixes(h: np.ndarray, first: np.ndarray, ids: np.ndarray, hashes: np.ndarray, frequent: np.ndarray, groups: int,
                   width: int) -> Iterator[tuple]:
    """A block's rows: repeats inside it (group -1), and for each group the
    earliest suffix of each distinct window."""
    order = np.lexsort((hashes, ids))
    same = (ids[order][1:] == ids[order][:-1]) & (hashes[order][1:] == hashes[order][:-1])
    order = order[np.concatenate([[True], ~same])] if len(order) else order  # a repeated row is the same document
    ids, hashes, lo, size = ids[order], hashes[order], first[:-1][order], np.diff(first)[order]
    n = np.maximum(size - width + 1, 0)
    if not n.sum():
        return
    at = ranges(lo, n)
    doc = np.repeat(np.arange(len(n)), n)
    start = at - lo[doc]
    power, inverse = _power_table(_Q, len(h) + 1)
    total = np.zeros(len(h) + 1, dtype=np.uint64)
    np.cumsum(h * power[:len(h)], out=total[1:])
    label = mix((total[at + width] - total[at]) * inverse[at])
    by_label = np.argsort(label)
    ordered = label[by_label]
    head = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
    earliest = np.minimum.reduceat(by_label, head)
    again = np.ones(len(label), dtype=bool)
    again[earliest] = False
    if again.any():
        yield (-1, *pack_starts(doc[again], start[again], ids, hashes), b"")
    one = np.flatnonzero(~again)
    group = (prefix_hashes(h, frequent, width)[at[one]] % np.uint64(groups)).astype(np.int64)
    by_group = np.argsort(group, kind="stable")
    one, group = one[by_group], group[by_group]
    heads = np.flatnonzero(np.diff(group, prepend=-1)).tolist()
    for i, j in zip(heads, [*heads[1:], len(one)], strict=True):
        k = one[i:j]
        yield (int(group[i]), *pack_starts(doc[k], start[k], ids, hashes), label[k].tobytes())


def suffixes(docs: DataFrame, frequent: np.ndarray, groups: int, width: int) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(frequent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId()
        for b in batches:
            ids = b.column(0).fill_null(_LAST).to_numpy(zero_copy_only=False)
            hashes = b.column(1).to_numpy(zero_copy_only=False)
            for i, j, data, offsets in text_blocks(b.column(2)):
                h, _, _, first = word_hashes(data, offsets, RAW_WORDS)
                block += 1
                for grp, *row in block_suffixes(h, first, ids[i:j], hashes[i:j], shared.value, groups, width):
                    cells = [pa.array([block % groups if grp < 0 else grp], pa.int32()), *[pa.array([x], pa.binary()) for x in row]]
                    yield pa.RecordBatch.from_arrays(cells, ["grp", "docs", "hashes", "counts", "gaps", "labels"])

    return docs.select("doc_id", "hash", "text").mapInArrow(run, _SUFFIXES)


def repeats(parts: list[dict]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(id, hash, start) of every repeat of one group."""
    ids, hashes, starts, labels = [], [], [], []
    for p in parts:
        d, x, count, start = unpack_starts(p["docs"], p["hashes"], p["counts"], p["gaps"])
        if p["labels"]:
            ids.append(np.repeat(d, count))
            hashes.append(np.repeat(x, count))
            starts.append(start.astype(np.int32))
            labels.append(np.frombuffer(p["labels"], np.uint64))
        else:  # repeats of a block
            yield np.repeat(d, count), np.repeat(x, count), start.astype(np.int32)
    if not labels:
        return
    label = np.concatenate(labels)
    order = np.argsort(label)
    ordered = label[order]
    equal = ordered[1:] == ordered[:-1]
    inner = np.concatenate([[False], equal]) | np.concatenate([equal, [False]])  # leaves below a shared node
    order, node = order[inner], ordered[inner]
    if not len(order):
        return
    d, x, s = (np.concatenate(a)[order] for a in (ids, hashes, starts))
    by = np.lexsort((s, x, d, node))
    d, x, s, node = d[by], x[by], s[by], node[by]
    head = np.flatnonzero(np.concatenate([[True], node[1:] != node[:-1]]))
    of = np.repeat(head, np.diff(np.append(head, len(node))))
    later = (d != d[of]) | (x != x[of]) | (s != s[of])
    yield d[later], x[later], s[later]


def all_repeats(parts: DataFrame, groups: int) -> DataFrame:
    """The starts of repeated windows, packed by bucket of documents."""

    def emit(parts: list[dict]) -> Iterator[pa.RecordBatch]:
        found = list(repeats(parts))
        if not found:
            return
        d, x, s = (np.concatenate([f[i] for f in found]) for i in range(3))
        bucket = (d % groups + x % groups) % groups
        by = np.lexsort((s, x, d, bucket))
        d, x, s, bucket = d[by], x[by], s[by], bucket[by]
        new = np.concatenate([[True], (d[1:] != d[:-1]) | (x[1:] != x[:-1])]) if len(d) else np.zeros(0, bool)
        doc = np.cumsum(new) - 1
        heads = np.flatnonzero(np.diff(bucket, prepend=-1)).tolist()
        for i, j in zip(heads, [*heads[1:], len(d)], strict=True):
            row = pack_starts(doc[i:j], s[i:j].astype(np.int64), d[new], x[new])
            yield pa.RecordBatch.from_arrays([pa.array([int(bucket[i])], pa.int32()), *[pa.array([c], pa.binary()) for c in row]],
                                             ["bucket", "docs", "hashes", "counts", "gaps"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, parts = None, []
        for b in batches:
            for r in b.to_pylist():
                if r["grp"] != held:
                    yield from emit(parts)
                    held, parts = r["grp"], []
                parts.append(r)
        yield from emit(parts)

    return (parts.repartitionById(groups, "grp").sortWithinPartitions("grp")
            .mapInArrow(run, "bucket int, docs binary, hashes binary, counts binary, gaps binary"))


class Starts:
    """Repeats of a bucket's documents, by (id, hash)."""

    def __init__(self, parts: list[tuple]):
        found = [unpack_starts(*p) for p in parts]
        count = [f[2] for f in found]
        d, x, s = (np.concatenate(a) if a else np.zeros(0, np.int64) for a in (
            [np.repeat(f[0], c) for f, c in zip(found, count, strict=True)], [np.repeat(f[1], c) for f, c in zip(found, count, strict=True)], [f[3] for f in found]))
        by = np.lexsort((x, d))
        d, x, self.start = d[by], x[by], s[by]
        head = np.flatnonzero(np.concatenate([[True], (d[1:] != d[:-1]) | (x[1:] != x[:-1])])) if len(d) else np.zeros(0, np.int64)
        self.at = dict(zip(zip(d[head].tolist(), x[head].tolist(), strict=True), zip(head.tolist(), [*head[1:].tolist(), len(d)], strict=False), strict=True))

    def of(self, doc_id: int, text_hash: int) -> np.ndarray | None:
        span = self.at.get((doc_id, text_hash))
        return None if span is None else self.start[span[0]:span[1]]


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH,
                   group_words: int = GROUP_WORDS) -> DataFrame:
    """doc_id, n_words, n_removed, kept (the remaining words, joined by one
    space) for every row of ``docs``."""
    kind = docs.schema[id_col].dataType
    if not isinstance(kind, T.IntegralType):
        raise TypeError(f"{id_col} must be an integer column, not {kind.simpleString()}")
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("hash"), text.alias("text"))
    counts = word_counts(rows)
    groups = int(counts.sum() // group_words) + 1
    found = all_repeats(suffixes(rows, counts > group_words, groups, width), groups)
    key = F.coalesce("doc_id", F.lit(int(_LAST)))
    bucket = F.pmod(F.pmod(key, F.lit(groups)) + F.pmod(F.col("hash"), F.lit(groups)), F.lit(groups)).cast("int")
    # a bucket's repeats come before its documents, which stream past them
    both = rows.select(bucket.alias("bucket"), F.lit(1).alias("kind"), "doc_id", "hash", "text").unionByName(
        found.withColumn("kind", F.lit(0)), allowMissingColumns=True)

    def rebuild(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, parts, starts = None, [], None
        for b in batches:
            out = ([], [], [], [])
            for bucket, kind, doc_id, text_hash, text, *packed in zip(*(b.column(i) for i in range(9)), strict=True):
                if bucket.as_py() != held:
                    held, parts, starts = bucket.as_py(), [], None
                if kind.as_py() == 0:
                    parts.append(tuple(x.as_py() for x in packed))
                    continue
                if starts is None:
                    starts, parts = Starts(parts), []
                words = text.as_buffer().to_pybytes().split()
                n = len(words)
                s = starts.of(_LAST if not doc_id.is_valid else doc_id.as_py(), text_hash.as_py())
                if s is not None:
                    edge = np.bincount(s, minlength=n + 1) - np.bincount(s + width, minlength=n + 1)
                    words = [w for w, c in zip(words, np.cumsum(edge)[:n].tolist(), strict=True) if c == 0]
                out[0].append(doc_id.as_py())
                out[1].append(n)
                out[2].append(n - len(words))
                out[3].append(b" ".join(words))
            yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.int64()), pa.array(out[3], pa.binary()).cast(pa.string())],
                                             ["doc_id", "n_words", "n_removed", "kept"])

    return (both.repartitionById(groups, "bucket").sortWithinPartitions("bucket", "kind")
            .select("bucket", "kind", "doc_id", "hash", "text", "docs", "hashes", "counts", "gaps")
            .mapInArrow(rebuild, "doc_id long, n_words long, n_removed long, kept string").withColumn("doc_id", F.col("doc_id").cast(kind)))


ORACLE = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS (SELECT doc_id, i, array_to_string(w[i:i + 19], ' ') AS s FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - 19)) AS i FROM d WHERE len(w) >= 20)),
rep AS (SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY s ORDER BY doc_id, i) AS k FROM win) WHERE k > 1),
gone AS (SELECT DISTINCT doc_id, unnest(generate_series(i, i + 19)) AS p FROM rep),
words AS (SELECT doc_id, unnest(w) AS word, unnest(generate_series(1, len(w))) AS p FROM d),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS t, count(*) AS n FROM words ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""
