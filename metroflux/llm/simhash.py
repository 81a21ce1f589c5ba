"""SimHash near-dedup by covering locality-sensitive hashing.

A fingerprint bit is set when more than half of the document's shingle
hashes (XXH64 of the space-joined words, seed 42) have it set.  Documents
whose fingerprints differ in at most ``radius`` bits are linked.

Candidates come from a covering family of masks.  Every bit is given a
vector of ``radius + 1`` bits; for each non-zero vector ``v`` the mask of
table ``v`` holds the bits whose vector has an odd product with ``v``.  The
vectors of at most ``radius`` differing bits do not span the space, so some
``v`` is orthogonal to all of them and its mask hides every difference: each
pair within the radius meets in at least one of the ``2**(radius+1) - 1``
tables, with certainty.  A true distance decides.

Only distinct fingerprints are looked up (``masks`` times each), and a bucket
gives at most one edge a fingerprint, to the smallest one of its own linked
group.  A bucket of more than ``BUCKET`` fingerprints is dealt out again by
the same covering over the bits its mask left free (about half), whose
buckets hold at most ``2**17`` distinct fingerprints by construction; the
largest still go on in the task by coverings of ever fewer free bits, and
parts whose members are linked already are passed over.  So no bucket is
capped and none is compared pair by pair.

Defined cases: a null text is empty; a text of no words has fingerprint zero,
linked like any other; one of fewer words than a shingle is one shingle;
rows are never merged (repeated rows and null ids each give a row); a
component is named by its smallest id, null if it has none; an empty table
gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from metroflux.llm.common import LOWER_WORDS, materialise, text_blocks
from metroflux.llm.components import connected_components

WIDTH = 4
RADIUS = 4
SEED = 42
BITS = 64
#: fingerprints of a bucket that one task holds before the bucket is dealt out again
BUCKET = 1 << 16
#: members of a bucket that are compared with each other in one matrix (in
#: strips of STRIP rows), and those of the buckets that are compared together
DIRECT = 4096
STRIP = 256
SMALL = 32
#: fingerprints that a task links at a time
BLOCK = 1 << 16
#: shingles whose bits are counted at a time
SHINGLES = 1 << 16


# --- fingerprints ------------------------------------------------------------

def _normal_words(data: np.ndarray, offsets: np.ndarray) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray]:
    """The texts' words, lower-cased and joined by one byte of space: (bytes,
    start and end of each word, first word of each text)."""
    is_word, value = LOWER_WORDS
    m = is_word[data]
    last = np.zeros(len(data), dtype=bool)  # the last byte of its word
    last[:-1] = m[:-1] & ~m[1:]
    text_end = offsets[1:] - 1
    text_end = text_end[(text_end >= 0) & (offsets[1:] > offsets[:-1])]
    last[text_end] = m[text_end]
    at = np.flatnonzero(m)
    ends = np.flatnonzero(last[at]) + 1
    kept = value[data[at]]
    joined = np.insert(kept, ends, 0x20)
    word = np.arange(len(ends), dtype=np.int64)
    ends = ends + word
    starts = np.concatenate([[0], ends[:-1] + 1])[:len(ends)]
    return joined.tobytes(), starts, ends, np.searchsorted(at[ends - word - 1], offsets)


def fingerprints_of(column: pa.Array, width: int = WIDTH) -> np.ndarray:
    """The 64-bit fingerprint of every text of a column."""
    out = np.zeros(len(column), dtype=np.uint64)
    digest = xxhash.xxh64_intdigest
    for i, j, data, offsets in text_blocks(column):
        text, starts, ends, first = _normal_words(data, offsets)
        n_words = np.diff(first)
        n = np.where(n_words >= width, n_words - width + 1, np.minimum(n_words, 1))  # shingles of each text
        # a shingle's first word, and its last one
        begin = np.repeat(first[:-1] - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(int(n.sum()))
        final = begin + np.repeat(np.minimum(n_words, width) - 1, n)
        owner = np.repeat(np.arange(j - i), n)
        ones = np.zeros((j - i, BITS), dtype=np.int64)
        lo, hi = starts[begin], ends[final]
        for a in range(0, len(begin), SHINGLES):
            b = a + SHINGLES
            h = np.array([digest(text[s:e], SEED) for s, e in zip(lo[a:b].tolist(), hi[a:b].tolist(), strict=True)], dtype="<u8")
            bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            whose = owner[a:b]
            cut = np.flatnonzero(np.concatenate([[True], whose[1:] != whose[:-1]]))
            ones[whose[cut]] += np.add.reduceat(bits, cut, axis=0, dtype=np.int64)
        packed = np.packbits(2 * ones > n[:, None], axis=1, bitorder="little")
        out[i:j] = np.ascontiguousarray(packed).view("<u8").reshape(-1)
    return out


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH) -> DataFrame:
    """doc_id, fp (the fingerprint as a signed 64-bit integer) of every row."""
    frame = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = fingerprints_of(b.column("text"), width).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(fp)], ["doc_id", "fp"])

    return frame.mapInArrow(run, f"doc_id {frame.schema['doc_id'].dataType.simpleString()}, fp bigint")


# --- covering masks ----------------------------------------------------------

def covering_masks(bits: list[int], radius: int) -> list[int]:
    """Masks over the given bit positions, such that every set of at most
    ``radius`` of them is missed by some mask."""
    space = 1 << (radius + 1)
    vector = {b: k % (space - 1) + 1 for k, b in enumerate(bits)}
    return [sum(1 << b for b in bits if (vector[b] & v).bit_count() % 2) for v in range(1, space)]


def _free(mask: int) -> list[int]:
    return [b for b in range(BITS) if not mask >> b & 1]


def _signed(x: int) -> int:
    return x - (1 << BITS) if x >> (BITS - 1) else x


def _unite(label: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Merge the groups of the pairs (i, j); a group's label is its smallest
    index, and every label is a root before and after."""
    while True:
        a, b = label[i], label[j]
        apart = a != b
        if not apart.any():
            return label
        i, j, a, b = i[apart], j[apart], a[apart], b[apart]
        np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
        while True:
            up = label[label]
            if np.array_equal(up, label):
                break
            label = up


def _link_small(bucket: np.ndarray, fp: np.ndarray, label: np.ndarray, rows: np.ndarray, radius: int) -> np.ndarray:
    """Link ``rows`` (ordered by their bucket) with those of the same bucket,
    one distance in the order at a time."""
    f = fp[rows]
    shift, live = 1, np.arange(max(len(rows) - 1, 0))
    while len(live):
        live = live[live + shift < len(rows)]
        live = live[bucket[live] == bucket[live + shift]]
        near = live[np.bitwise_count(f[live] ^ f[live + shift]) <= radius]
        if len(near):
            label = _unite(label, rows[near], rows[near + shift])
        shift += 1
    return label


def _link_matrix(fp: np.ndarray, label: np.ndarray, rows: np.ndarray, radius: int) -> np.ndarray:
    """Link the members ``rows`` of one bucket, a strip of comparisons at a time."""
    f = fp[rows]
    for i in range(0, len(rows), STRIP):
        own = label[rows]
        if (own == own[0]).all():
            break
        near = np.bitwise_count(f[i:i + STRIP, None] ^ f[None, i:]) <= radius
        near &= own[i:i + STRIP, None] != own[None, i:]
        x, y = np.nonzero(near)
        if len(x):
            label = _unite(label, rows[x + i], rows[y + i])
    return label


def _link_large(fp: np.ndarray, mask: int, radius: int, direct: int) -> np.ndarray:
    """Labels of the members of one bucket, which agree on ``mask``.  Up to
    ``direct`` members are compared with each other; more are dealt out by a
    covering of the other bits, and so on, down to 8 free bits (256 members)."""
    label = np.arange(len(fp))
    work = [(np.arange(len(fp)), mask)]
    while work:
        rows, mask = work.pop()
        free = _free(mask)
        if len(rows) <= direct or len(free) <= 8:
            label = _link_matrix(fp, label, rows, radius)
            continue
        for sub in covering_masks(free, radius):
            if (label[rows] == label[rows[0]]).all():
                break  # linked already: no pair of them can change anything
            key = fp[rows] & np.uint64(sub)
            order = np.argsort(key, kind="stable")
            key, member = key[order], rows[order]
            start = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
            size = np.diff(np.concatenate([start, [len(key)]]))
            few = np.repeat(size <= SMALL, size)
            label = _link_small(key[few], fp, label, member[few], radius)
            work += [(member[x:x + n], mask | sub) for x, n in zip(start[size > SMALL].tolist(), size[size > SMALL].tolist(), strict=True)]
    return label


def _link(batches: Iterator[pa.RecordBatch], radius: int, mask_of, direct: int, block: int) -> Iterator[pa.RecordBatch]:
    """Edges (a, b) from rows (k, b, fp) that come bucket by bucket: every
    fingerprint to the smallest of its group, once a bucket."""

    def edges(k: np.ndarray, b: np.ndarray, fp: np.ndarray) -> pa.RecordBatch:
        change = (k[1:] != k[:-1]) | (b[1:] != b[:-1])
        start = np.flatnonzero(np.concatenate([[True], change]))
        size = np.diff(np.concatenate([start, [len(k)]]))
        bucket = np.repeat(np.arange(len(start)), size)
        f, label = fp.view(np.uint64), np.arange(len(k))
        small = np.flatnonzero(np.repeat(size <= SMALL, size))
        label = _link_small(bucket[small], f, label, small, radius)
        for s, n in zip(start[size > SMALL].tolist(), size[size > SMALL].tolist(), strict=True):
            label[s:s + n] = s + _link_large(f[s:s + n], mask_of(int(k[s])), radius, direct)
        linked = np.flatnonzero(label != np.arange(len(k)))
        return pa.RecordBatch.from_arrays([pa.array(fp[label[linked]]), pa.array(fp[linked])], ["a", "b"])

    held: list[tuple] = []
    n = 0
    for batch in batches:
        k, b, fp = (batch.column(c).to_numpy() for c in ("k", "b", "fp"))
        if not len(k):
            continue
        held.append((k, b, fp))
        n += len(k)
        if n >= block:
            k, b, fp = (np.concatenate(x) for x in zip(*held, strict=True))
            # the last bucket may go on in the next batch
            end = int(np.flatnonzero(np.concatenate([[True], (k[1:] != k[:-1]) | (b[1:] != b[:-1])]))[-1])
            if end:
                yield edges(k[:end], b[:end], fp[:end])
            held, n = [(k[end:], b[end:], fp[end:])], len(k) - end
    if n:
        yield edges(*(np.concatenate(x) for x in zip(*held, strict=True)))


def _buckets(rows: DataFrame, masks: list[list[int]]) -> DataFrame:
    """Rows (k, b, fp): table and bucket of every fingerprint in every table.
    Rows that come with an outer table k and bucket b are dealt out inside of
    it, by the masks of that table.  A bucket is named by a 64-bit hash of its
    table, outer bucket and bits; two of one name in one table are only looked
    through together."""
    tables = len(masks[0])
    literal = F.array(*[F.lit(_signed(m)) for family in masks for m in family])
    at = F.col("k") * tables + F.col("i")
    dealt = rows.select("*", F.explode(F.sequence(F.lit(0), F.lit(tables - 1))).alias("i")).select(at.alias("k"), "b", "fp")
    return dealt.select("k", F.xxhash64("k", "b", F.col("fp").bitwiseAND(F.get(literal, F.col("k")))).alias("b"), "fp")


def links(fps: DataFrame, radius: int = RADIUS, bucket: int = BUCKET) -> DataFrame:
    """Edges (a, b) between distinct fingerprints of column fp (distinct
    already) whose components are those of all pairs within ``radius``."""
    masks = covering_masks(list(range(BITS)), radius)
    inner = [covering_masks(_free(m), radius) for m in masks]
    first = _buckets(fps.select(F.lit(0).alias("k"), F.lit(0).cast("bigint").alias("b"), "fp"), [masks])
    large = materialise(first.groupBy("k", "b").count().where(F.col("count") > bucket).select("k", "b"), "large-buckets")
    dealt_again = _buckets(first.join(large, ["k", "b"], "left_semi"), inner)

    direct, block = DIRECT, BLOCK

    def linked(rows: DataFrame, mask_of) -> DataFrame:
        ordered = rows.select("k", "b", "fp").repartition("b").sortWithinPartitions("b", "k", "fp")
        return ordered.mapInArrow(lambda batches: _link(batches, radius, mask_of, direct, block), "a bigint, b bigint")

    edges = linked(first.join(large, ["k", "b"], "left_anti"), lambda k: masks[k])
    if not large.isEmpty():
        edges = edges.unionByName(linked(dealt_again, lambda k: masks[k // len(masks)] | inner[k // len(masks)][k % len(masks)]))
    return edges.distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH, radius: int = RADIUS,
                    bucket: int = BUCKET) -> DataFrame:
    """One row per row of ``docs``: doc_id, fingerprint (16 hex digits),
    component_id (smallest id reachable by links)."""
    rows = materialise(fingerprints(docs, id_col, text_col, width), "fingerprints")
    first = materialise(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct-fingerprints")
    grouped = connected_components(links(first.select("fp"), radius, bucket))
    root = first.join(grouped, first["fp"] == grouped["node"], "left").select("fp", "least", F.coalesce("component", "fp").alias("root"))
    members = materialise(root, "members")
    named = materialise(members.groupBy(F.col("root").alias("of")).agg(F.min("least").alias("component_id")), "named")
    # stored tables, so that a hot root or fingerprint is split by adaptive execution
    of = materialise(members.join(named, F.col("root") == F.col("of")).select(F.col("fp").alias("of"), "component_id"), "components")
    return rows.join(of, F.col("fp") == F.col("of")).select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
