"""Vector code compression: product codes by tries over distinct parts.

A vector is scaled to integers and cut into equal consecutive parts; a code
names for every part the nearest entry of that part position's codebook.
Assignment walks a lexicographic trie over the distinct parts of a block of
vectors: a node is a prefix of dimensions and holds one accumulated distance
to every entry, which all parts below it share; a leaf takes the smallest
(ties to the lower index).  The walk is depth first, so it holds one path of
distance vectors and one subtree of at most ``SUBTREE`` leaves, which is
done level by level at once.

Training reads the vectors once a round, map side only: each task's leaves
add up the weighted sums and counts of their entries, and Spark sums the
``parts x entries`` rows of the tasks.  The driver holds the codebooks
(``entries`` vectors, a parameter).  Nothing but those rows is shuffled; the
tries are built a block at a time and not over the whole table, because the
table's distinct parts would have to be shuffled and their codes joined back
to every vector (``README`` has figures).

Defined cases.  A vector that is null or holds a null or non-finite
component is dropped.  The codebooks' length is that of the vector with the
smallest id among those whose length is a positive multiple of ``parts``; a
kept vector of another length stays with null code and error.  The first
entries are the vectors of the smallest distinct ids, a null id after every
other; of several vectors with one id the lexicographically smallest counts.
With fewer distinct ids than entries the codebooks are shorter.  Repeated
rows each count.  An empty table gives an empty result.  A component beyond
2**24 after scaling raises an error, since distances would pass 64 bits.
Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from metroflux.llm.common import materialise

SCALE = 256
PARTS = 16
ENTRIES = 64
ROUNDS = 2
#: distinct parts of a subtree that is done level by level
SUBTREE = 8192
#: vector components that a block holds
BLOCK = 1 << 21
#: components beyond this after scaling are an error (distances stay in 64 bits)
LARGEST = 1 << 24


@dataclass(frozen=True)
class Codebooks:
    """``books[p, e]`` is entry e of part position p (integers); a table
    without a usable vector has ``books`` of no entries."""

    books: np.ndarray  # (parts, entries, width)

    @property
    def length(self) -> int:
        return self.books.shape[0] * self.books.shape[2] if self.books.shape[1] else -1

    def sha256(self) -> str:
        return hashlib.sha256(",".join(map(str, self.books.reshape(-1).tolist())).encode()).hexdigest()


# --- the vectors of a task ---------------------------------------------------

def _scaled(column: pa.Array, scale: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(kept row numbers, their lengths, offsets, scaled components) of a
    list column; the components are those of the kept rows, end to end."""
    column = column.cast(pa.large_list(pa.float64()))
    valid = np.asarray(column.is_valid())
    offsets = np.asarray(column.offsets)
    flat = column.values
    bad = ~np.isfinite(flat.fill_null(np.nan).to_numpy(zero_copy_only=False)) if len(flat) else np.zeros(0, dtype=bool)
    faults = np.concatenate([[0], np.cumsum(bad)])
    keep = np.flatnonzero(valid & (faults[offsets[1:]] == faults[offsets[:-1]]))
    lengths = (offsets[1:] - offsets[:-1])[keep]
    values = flat.fill_null(0.0).to_numpy(zero_copy_only=False)
    inside = np.zeros(len(values) + 1, dtype=np.int64)
    np.add.at(inside, offsets[keep], 1)
    np.add.at(inside, offsets[keep] + lengths, -1)
    x = np.floor(values[np.cumsum(inside)[:-1] > 0] * scale)
    if len(x) and np.abs(x).max() > LARGEST:
        raise ValueError(f"a vector component is beyond {LARGEST} after scaling by {scale}")
    return keep, lengths, np.cumsum(lengths) - lengths, x.astype(np.int64)


def _matrix(rows: np.ndarray, offsets: np.ndarray, x: np.ndarray, length: int) -> np.ndarray:
    """The vectors ``rows`` (all of ``length``) as a matrix."""
    return x[offsets[rows][:, None] + np.arange(length)[None, :]]


def _first_vectors(frame: DataFrame, parts: int, entries: int, scale: int) -> np.ndarray:
    """The vectors of the smallest ids: every task names its ``entries``
    smallest, Spark merges them.  At most ``entries`` rows reach the driver."""
    id_type = frame.schema["id"].dataType
    id_arrow = to_arrow_type(id_type)

    def id_order(i):
        return (True, 0) if i is None else (False, i)

    def smallest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int, dict] = {}  # length -> {id: vector}
        for b in batches:
            keep, lengths, offsets, x = _scaled(b.column("v"), scale)
            ids = b.column("id").to_pylist()
            for n in np.unique(lengths[(lengths > 0) & (lengths % parts == 0)]).tolist():
                have = best.setdefault(n, {})
                rows = np.flatnonzero(lengths == n)
                stay = set(sorted({ids[k] for k in keep[rows].tolist()} | set(have), key=id_order)[:entries])
                for r in rows.tolist():
                    if (i := ids[keep[r]]) in stay:
                        v = x[offsets[r]:offsets[r] + n].tolist()
                        have[i] = min(v, have.get(i, v))
                best[n] = {i: v for i, v in have.items() if i in stay}
        out = [(i, v) for have in best.values() for i, v in have.items()]
        yield pa.RecordBatch.from_pydict({"id": pa.array([i for i, _ in out], id_arrow), "v": pa.array([v for _, v in out], pa.list_(pa.int64()))})

    named = frame.mapInArrow(smallest, f"id {id_type.simpleString()}, v array<bigint>").withColumn("n", F.size("v"))
    by_id = [F.col("id").isNull(), F.col("id")]
    length = named.orderBy(*by_id, "v").limit(1).collect()
    if not length:
        return np.zeros((0, 0), dtype=np.int64)
    rows = (named.where(F.col("n") == length[0]["n"]).groupBy("id").agg(F.min("v").alias("v"))
            .orderBy(*by_id).limit(entries).collect())
    return np.array([r["v"] for r in rows], dtype=np.int64)


# --- the trie ----------------------------------------------------------------

def _distinct_sorted(part: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct rows in lexicographic order, the distinct row of every row,
    and the number of rows of each."""
    order = np.lexsort(part.T[::-1])
    s = part[order]
    new = np.ones(len(s), dtype=bool)
    new[1:] = (s[1:] != s[:-1]).any(axis=1)
    which = np.empty(len(s), dtype=np.int64)
    which[order] = np.cumsum(new) - 1
    return s[new], which, np.bincount(which)


def nearest(leaves: np.ndarray, book: np.ndarray, subtree: int = SUBTREE) -> tuple[np.ndarray, np.ndarray]:
    """(entry, squared distance) of every distinct part: ``leaves`` is sorted
    lexicographically, so a trie node is a run of rows."""
    n, width = leaves.shape
    entry, distance = np.empty(n, dtype=np.int64), np.empty(n, dtype=np.int64)
    stack = [(0, n, 0, np.zeros(len(book), dtype=np.int64))]
    while stack:  # depth first: (first row, end row, depth, distances so far)
        lo, hi, depth, so_far = stack.pop()
        run = leaves[lo:hi]
        if hi - lo > subtree and depth < width:
            cuts = np.concatenate([[0], np.flatnonzero(np.diff(run[:, depth])) + 1, [hi - lo]])
            for a, b in zip(cuts[-2::-1].tolist(), cuts[:0:-1].tolist(), strict=True):
                step = run[a, depth] - book[:, depth]
                stack.append((lo + a, lo + b, depth + 1, so_far + step * step))
            continue
        # a subtree: the nodes of a level are the runs with an equal prefix
        sums, node = so_far[None, :], np.zeros(hi - lo, dtype=np.int64)
        for d in range(depth, width):
            starts = np.ones(hi - lo, dtype=bool)
            starts[1:] = (run[1:, d] != run[:-1, d]) | (node[1:] != node[:-1])
            first = np.flatnonzero(starts)
            step = run[first, d][:, None] - book[None, :, d]
            sums = sums[node[first]] + step * step
            node = np.cumsum(starts) - 1
        best = sums.argmin(axis=1)
        entry[lo:hi], distance[lo:hi] = best[node], sums[np.arange(len(best)), best][node]
    return entry, distance


def _assign(vectors: np.ndarray, books: np.ndarray, subtree: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """For every part position: distinct parts, their multiplicities, the
    entry and distance of every vector's part."""
    parts, _, width = books.shape
    for p in range(parts):
        leaves, which, weight = _distinct_sorted(vectors[:, p * width:(p + 1) * width])
        entry, distance = nearest(leaves, books[p], subtree)
        yield leaves, weight, entry, np.stack([entry[which], distance[which]])


def _blocks(keep: np.ndarray, length: int, block: int) -> Iterator[np.ndarray]:
    step = max(1, block // max(length, 1))
    for i in range(0, len(keep), step):
        yield keep[i:i + step]


def _round(frame: DataFrame, books: Codebooks, scale: int) -> Codebooks:
    """Replace every used entry by the mean of its parts, rounded down."""
    b = books.books
    parts, entries, width = b.shape
    length, subtree, block = books.length, SUBTREE, BLOCK

    def collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, count = np.zeros((parts, entries, width), dtype=np.int64), np.zeros((parts, entries), dtype=np.int64)
        for batch in batches:
            _, lengths, offsets, x = _scaled(batch.column("v"), scale)
            for rows in _blocks(np.flatnonzero(lengths == length), length, block):
                for p, (leaves, weight, entry, _) in enumerate(_assign(_matrix(rows, offsets, x, length), b, subtree)):
                    for d in range(width):  # below 2**53 in a block: exact
                        total[p, :, d] += np.bincount(entry, leaves[:, d] * weight, entries).astype(np.int64)
                    count[p] += np.bincount(entry, weight, entries).astype(np.int64)
        p, e = np.nonzero(count)
        yield pa.RecordBatch.from_pydict({"p": pa.array(p, pa.int32()), "e": pa.array(e, pa.int32()), "n": pa.array(count[p, e], pa.int64()),
                                          "s": pa.array(total[p, e].tolist(), pa.list_(pa.int64()))})

    whole = "decimal(20,0)"
    sums = (frame.select("v").mapInArrow(collect, "p int, e int, n bigint, s array<bigint>").groupBy("p", "e")
            .agg(F.sum(F.col("n").cast(whole)).alias("n"), F.array(*[F.sum(F.col("s")[i].cast(whole)) for i in range(width)]).alias("s")))
    new = b.copy()
    for r in sums.collect():  # at most parts x entries rows
        new[r["p"], r["e"]] = [int(x) // int(r["n"]) for x in r["s"]]
    return Codebooks(new)


def _frame(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    return df.select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("v"))


def train(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", parts: int = PARTS, entries: int = ENTRIES,
          rounds: int = ROUNDS, scale: int = SCALE) -> Codebooks:
    """The codebooks after ``rounds`` rounds of assignment and replacement."""
    if not 0 < entries <= 256:
        raise ValueError("entries must be 1 to 256: a code gives two hex digits a part")
    frame = _frame(df, id_col, vector_col)
    first = _first_vectors(frame, parts, entries, scale)
    if not len(first):
        return Codebooks(np.zeros((parts, 0, 0), dtype=np.int64))
    books = Codebooks(first.reshape(len(first), parts, -1).transpose(1, 0, 2).copy())
    for _ in range(rounds):
        books = _round(frame, books, scale)
    return books


def encode(df: DataFrame, books: Codebooks, vector_col: str = "embedding", scale: int = SCALE) -> DataFrame:
    """The kept rows of ``df`` with ``code`` (two hex digits a part) and
    ``error`` (squared distance to the named entries) after its columns,
    which must not have these names."""
    b, length, subtree, block = books.books, books.length, SUBTREE, BLOCK
    names = [c for c in df.columns if c != vector_col]
    frame = df.select(F.col(vector_col).cast("array<double>").alias("v"), F.struct(F.lit(0).alias("_"), *[df[n].alias(f"c{i}") for i, n in enumerate(names)]).alias("row"))

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep, lengths, offsets, x = _scaled(batch.column("v"), scale)
            codes = np.zeros(len(keep), dtype=object)
            codes[:] = None
            errors, known = np.zeros(len(keep), dtype=np.int64), lengths == length
            for rows in _blocks(np.flatnonzero(known), length, block):
                found = np.stack([f for *_, f in _assign(_matrix(rows, offsets, x, length), b, subtree)])
                errors[rows] = found[:, 1].sum(axis=0)
                digits = found[:, 0].T.astype(np.uint8).tobytes().hex()
                size = 2 * b.shape[0]
                codes[rows] = [digits[i:i + size] for i in range(0, len(digits), size)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("row").take(pa.array(keep)), pa.array(codes, pa.string()), pa.array(errors, pa.int64(), mask=~known)],
                ["row", "code", "error"])

    row = frame.schema["row"].dataType.simpleString()
    out = frame.mapInArrow(code, f"row {row}, code string, error bigint")
    return out.select(*[F.col("row")[f"c{i}"].alias(n) for i, n in enumerate(names)], "code", "error")


def compress(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", parts: int = PARTS,
             entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> DataFrame:
    """One row per kept vector: vec_id, code, error, label_error (errors
    summed over equal labels, nulls together), codebooks_sha256."""
    books = train(df, id_col, vector_col, parts, entries, rounds, scale)
    rows = materialise(encode(df.select(F.col(id_col).alias("vec_id"), F.col(label_col).alias("label"), F.col(vector_col).alias("embedding")),
                              books, scale=scale), "vector-codes")
    # stored, so that its size is known and a hot label's join can be split
    sums = materialise(rows.groupBy(F.col("label").alias("of")).agg(F.sum(F.col("error").cast("decimal(20,0)")).cast("bigint").alias("label_error")), "label-errors")
    return rows.join(sums, F.col("label").eqNullSafe(F.col("of"))).select(
        "vec_id", "code", "error", "label_error", F.lit(books.sha256()).alias("codebooks_sha256"))


def _round_sql(i: int) -> str:
    """Assignment to the books b{i}, then their replacement b{i + 1}."""
    return f"""
d{i} AS (SELECT k.vec_id, k.p, b.e, list_sum([(k.x[j] - b.c[j]) * (k.x[j] - b.c[j]) for j in range(1, k.w + 1)]) AS d
       FROM cut k JOIN b{i} b ON k.p = b.p),
a{i} AS (SELECT vec_id, p, min(d) AS d, min(e) FILTER (WHERE d = least_d) AS e
       FROM (SELECT *, min(d) OVER (PARTITION BY vec_id, p) AS least_d FROM d{i}) GROUP BY vec_id, p),
s{i} AS (SELECT a.p, a.e, j, CAST(sum(k.x[j]) AS HUGEINT) AS s, CAST(count(*) AS HUGEINT) AS n
       FROM a{i} a JOIN cut k ON a.vec_id = k.vec_id AND a.p = k.p, range(1, k.w + 1) t(j) GROUP BY a.p, a.e, j),
b{i + 1} AS (SELECT b.p, b.e, coalesce(m.c, b.c) AS c FROM b{i} b LEFT JOIN (
       SELECT p, e, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY j) AS c FROM s{i} GROUP BY p, e) m ON b.p = m.p AND b.e = m.e)"""


ORACLE = f"""
WITH kept AS MATERIALIZED (SELECT vec_id, label, [CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT) for x in embedding] AS v FROM embeddings
       WHERE embedding IS NOT NULL AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0),
cut AS MATERIALIZED (SELECT vec_id, label, p, len(v) // {PARTS} AS w, v[p * (len(v) // {PARTS}) + 1:(p + 1) * (len(v) // {PARTS})] AS x FROM kept, range({PARTS}) t(p)),
b0 AS (SELECT p, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS e, x AS c FROM cut QUALIFY e < {ENTRIES}),
{",".join(_round_sql(i) for i in range(ROUNDS + 1))},
coded AS (SELECT vec_id, string_agg(printf('%02x', e), '' ORDER BY p) AS code, CAST(sum(d) AS BIGINT) AS error FROM a{ROUNDS} GROUP BY vec_id),
books AS (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM b{ROUNDS})
SELECT c.vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM coded c JOIN kept k ON c.vec_id = k.vec_id, books
"""
