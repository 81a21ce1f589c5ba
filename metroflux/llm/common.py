"""Helpers shared by the training-data operators: shared-storage tables and
vectorised word hashing over Arrow text columns."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from metroflux.session import shared_dir

#: text bytes that one vectorised step holds at a time (a longer text is one step)
BLOCK_BYTES = 2 << 20
#: bytes that words are hashed from at a time (a longer word is one piece)
PIECE_BYTES = 1 << 16


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the cluster's shared folder, removed when the
    application ends."""
    path = f"{shared_dir(spark, 'llm')}/{name}-{uuid.uuid4().hex}"
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    jpath.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(jpath)
    return path


#: shuffle files go when the query ends that made them
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_scopes: list[list[DataFrame]] = []


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared folder and read it back:
    the lineage is cut, and a lost executor costs no recomputation.  The write
    runs once, so its shuffle files go with it."""
    spark = df.sparkSession
    path, before = shared_path(spark, name), spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    stored = spark.read.schema(df.schema).parquet(path)
    stored.stored_path = path
    if _scopes:
        _scopes[-1].append(stored)
    return stored


@contextmanager
def scratch() -> Iterator[Callable[[DataFrame], DataFrame]]:
    """Tables of ``materialise`` made inside are deleted at the end, except
    those given to the function this yields; they belong to the scope around."""
    kept = []
    _scopes.append([])
    try:
        yield lambda df: kept.append(df) or df
    finally:
        made = _scopes.pop()
        paths = {df.stored_path for df in kept}
        discard(*[df for df in made if df.stored_path not in paths])
        if _scopes:
            _scopes[-1] += kept


def outlive(df: DataFrame) -> None:
    """A table of the present scope belongs to the scope around it from now
    on, or stays until the application ends."""
    if _scopes:
        own = [x for x in _scopes[-1] if x.stored_path == df.stored_path]
        _scopes[-1] = [x for x in _scopes[-1] if x.stored_path != df.stored_path]
        if len(_scopes) > 1:
            _scopes[-2] += own


def unused(df: DataFrame, name: str) -> str:
    """``name``, or the first longer form of it that is no column of ``df``."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


#: words, of 64 bits, that a map of ids has at most
MARKS = 1 << 18


def _by_marks(docs: DataFrame, id_col: str, gone: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``docs`` in two: rows whose id is none of ``gone``'s, and the others,
    with few besides.  Decided where the rows are, by a bit map of the ids'
    hashes whose size is bounded; a fuller one lets more rows into the second."""
    word, bits = unused(docs, "word"), unused(docs, "bits")

    def place(c: Column) -> Column:
        return F.pmod(F.xxhash64(c), F.lit(MARKS))

    def bit(c: Column) -> Column:
        return F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftrightunsigned(F.xxhash64(c), 58).cast("int"))

    marks = gone.groupBy(place(gone["doc_id"]).alias(word)).agg(F.bit_or(bit(gone["doc_id"])).alias(bits))
    looked = docs.join(F.broadcast(marks), place(docs[id_col]) == F.col(word), "left")
    named = F.coalesce(F.col(bits).bitwiseAND(bit(docs[id_col])) != 0, F.lit(False))
    return looked.where(~named).drop(word, bits), looked.where(named).drop(word, bits)


def likely_rows(docs: DataFrame, id_col: str, named: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose id is one of ``named``'s (doc_id), with few
    besides, picked where they are."""
    return _by_marks(docs, id_col, named)[1]


def keep_rows(docs: DataFrame, id_col: str, key: Column, gone: DataFrame, repeated: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, without those that ``gone`` (doc_id,
    key; distinct) names, and one row of each that ``repeated`` names.  Only
    rows that may go are shuffled."""
    name = unused(docs, "row_key")

    def same(rows: DataFrame, named: DataFrame) -> Column:
        return rows[id_col].eqNullSafe(named["doc_id"]) & (rows[name] == named["key"])

    stay, may_go = _by_marks(docs, id_col, gone)
    may_go = may_go.withColumn(name, key)
    stay = stay.unionByName(may_go.join(gone, same(may_go, gone), "left_anti").drop(name))
    repeated = materialise(repeated, "repeated")
    if repeated.isEmpty():
        return stay
    marked = stay.withColumn(name, key)
    once = marked.join(repeated, same(marked, repeated), "left_semi").dropDuplicates([id_col, name])
    return marked.join(repeated, same(marked, repeated), "left_anti").unionByName(once).drop(name)


def discard(*tables: DataFrame) -> None:
    """Delete tables of ``materialise`` that nothing reads any more."""
    for df in tables:
        spark = df.sparkSession
        jpath = spark._jvm.org.apache.hadoop.fs.Path(df.stored_path)
        jpath.getFileSystem(spark._jsc.hadoopConfiguration()).delete(jpath, True)


# --- word tables -----------------------------------------------------------

def _byte_table(separators, lower: bool) -> tuple[np.ndarray, np.ndarray]:
    is_word = np.ones(256, dtype=bool)
    is_word[list(separators)] = False
    value = np.arange(256, dtype=np.uint8)
    if lower:
        value[65:91] += 32
        is_word[65:91] = is_word[97:123]
    return is_word, value


_SPACES = [0x20, *range(0x09, 0x0E)]
#: words [^\x20\x09-\x0D]+, unchanged
RAW_WORDS = _byte_table(_SPACES, lower=False)
#: words [^\x20\x09-\x0D]+ after lower-casing A-Z
LOWER_WORDS = _byte_table(_SPACES, lower=True)
#: words [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ after lower-casing A-Z
ALNUM_WORDS = _byte_table([*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)], lower=True)

_P = 0x9E3779B97F4A7C15  # odd multiplier of the byte hash
_Q = 0xD6E8FEB86659FD93  # odd multiplier of the word-sequence hash
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _power_table(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and its inverse mod 2**64 for i < n."""
    have = _powers.get(base)
    if have is None or len(have[0]) < n:
        size = max(n, 1 << 16)
        pair = []
        for b in (base, pow(base, -1, 1 << 64)):
            x = np.full(size, b, dtype=np.uint64)
            x[0] = 1
            pair.append(np.multiply.accumulate(x))
        have = _powers[base] = (pair[0], pair[1])
        if size > 2 * BLOCK_BYTES:  # one huge text: do not keep its table
            _powers.pop(base)
    return have


def mix(h: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit values."""
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    h = h ^ (h >> np.uint64(29))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def text_blocks(column: pa.Array | pa.ChunkedArray, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Cut a string column in runs of rows of about ``limit`` bytes: (first
    row, end row, bytes, row offsets into the bytes).  Null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    a = column.fill_null("").cast(pa.large_binary())
    offsets = np.frombuffer(a.buffers()[1], dtype=np.int64, count=a.offset + len(a) + 1)[a.offset:]
    data = a.buffers()[2]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    i = 0
    while i < len(a):
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, side="right")) - 1)
        yield i, j, data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i]
        i = j


def word_hashes(data: np.ndarray, offsets: np.ndarray, words: tuple[np.ndarray, np.ndarray]
                ) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words of the texts laid end to end in ``data``: 64-bit hash, start and
    end byte of each word, and for each text the index of its first word
    (one entry more than texts)."""
    is_word, value = words
    n = len(data)
    if n == 0:
        e = np.zeros(0, dtype=np.int64)
        return np.zeros(0, dtype=np.uint64), e, e, np.zeros(len(offsets), dtype=np.int64)
    m = is_word[data]
    before = np.empty(n, dtype=bool)
    before[0] = False
    before[1:] = m[:-1]
    cuts = offsets[offsets < n]
    before[cuts] = False
    starts = np.flatnonzero(m & ~before)
    after = np.empty(n, dtype=bool)
    after[-1] = False
    after[:-1] = m[1:]
    ends_at = offsets[1:] - 1
    after[ends_at[ends_at >= 0]] = False
    ends = np.flatnonzero(m & ~after) + 1
    h = np.empty(len(starts), dtype=np.uint64)
    i = 0
    while i < len(starts):  # piece by piece: a word's hash does not depend on where its piece begins
        lo = int(starts[i])
        j = max(i + 1, int(np.searchsorted(ends, lo + PIECE_BYTES, side="right")))
        size = int(ends[j - 1]) - lo
        power, inverse = _power_table(_P, max(size, PIECE_BYTES) + 1)
        total = np.zeros(size + 1, dtype=np.uint64)
        np.cumsum((value[data[lo:lo + size]].astype(np.uint64) + np.uint64(1)) * power[:size], out=total[1:])
        h[i:j] = (total[ends[i:j] - lo] - total[starts[i:j] - lo]) * inverse[starts[i:j] - lo]
        i = j
    h = mix(h ^ ((ends - starts).astype(np.uint64) * np.uint64(0xA0761D6478BD642F)))
    return h, starts, ends, np.searchsorted(starts, offsets)


def sequence_hashes(h: np.ndarray, width: int) -> np.ndarray:
    """Hash of every run of ``width`` consecutive values of ``h``."""
    n = len(h)
    if n < width:
        return np.zeros(0, dtype=np.uint64)
    power, inverse = _power_table(_Q, n + 1)
    total = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(h * power[:n], out=total[1:])
    return mix((total[width:] - total[:-width]) * inverse[:n - width + 1])


def ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Concatenated aranges start..start+count of each pair."""
    total = int(counts.sum())
    if total == 0:
        return np.zeros(0, dtype=np.int64)
    first = np.repeat(np.cumsum(counts) - counts, counts)
    return np.repeat(starts, counts) + np.arange(total, dtype=np.int64) - first
