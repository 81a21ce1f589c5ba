"""Sharding by sampled splitters, in DataFrame operations only.

Rows are ordered by (id, text checksum, row number).  A sample drawn with
probability in proportion to size gives quantile boundaries, which cut the
rows in ranges of about equal bytes; a range that holds more than ``FULL``
times its share is subdivided by boundaries sampled inside it, so that no
id, text or group of copies stays together in one task.  Exact totals of
the ranges and running sums inside them then give every row its place in
the whole order, and the place gives the shard.

Laws: ``bytes`` - shard sizes are equal to within one record; ``rows`` -
row counts differ by at most one; ``key`` - the id and the number of shards
decide (highest random weight), and with one more shard rows move only into
the new one (``grown_shard``).

Only the boundaries (at most ``MAX_RANGES`` in the first round, three
numbers each) and one total pass through the driver.

Defined cases: size is the UTF-8 bytes of the text plus 1 (null text: 1, its
checksum that of the empty text); null ids come last, and are one id for the
law ``key``; equal rows are told apart by their row number; an empty table
gives an empty result; extra columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from metroflux.llm.common import materialise
from metroflux.llm.linear import unit

RANGE_ROWS = 50_000
MAX_RANGES = 4096
SAMPLES = 32  # sampled rows for each boundary
FULL = 2
KEY = ["last", "id", "crc", "row"]


def _long_array(values: list) -> Column:
    """A constant array<long>."""
    return F.filter(F.split(F.lit(",".join(str(int(v)) for v in values)), ",").cast("array<bigint>"), lambda x: x.isNotNull())


def range_of(splitters: list[tuple]) -> Column:
    """Number of splitters at or before the row's key, by bisection."""
    if not splitters:
        return F.lit(0)
    at = [_long_array([s[i] for s in splitters]) for i in range(len(KEY))]

    def not_after(i: Column) -> Column:
        out = F.element_at(at[-1], i) <= F.col(KEY[-1])
        for a, k in zip(at[-2::-1], KEY[-2::-1], strict=True):
            x = F.element_at(a, i)
            out = (x < F.col(k)) | ((x == F.col(k)) & out)
        return out

    n = len(splitters)
    steps = [1 << b for b in range(n.bit_length() - 1, -1, -1)]
    return F.aggregate(F.array(*[F.lit(s) for s in steps]), F.lit(0),
                       lambda lo, step: F.when(lo + step > n, lo).when(not_after(F.least(lo + step, F.lit(n))), lo + step).otherwise(lo))


def _boundaries(rows: DataFrame, rate: Column, each: int) -> list[tuple]:
    """Every ``each``-th key of a size-weighted sample, range by range."""
    sample = rows.where(unit(F.lit(each), F.col("row"), F.col("id")) < F.col("size") * rate)
    ranked = sample.withColumn("k", F.row_number().over(Window.partitionBy("range").orderBy(*KEY)))
    return [tuple(r) for r in ranked.where(F.col("k") % each == 0).select(*KEY).collect()]


def splitters(rows: DataFrame, total_bytes: int, total_rows: int, shards: int, range_rows: int = RANGE_ROWS) -> list[tuple]:
    """Sorted boundaries that leave no range with more than ``FULL`` shares."""
    ranges = max(1, min(MAX_RANGES, max(4 * shards, total_rows // range_rows)))
    share = total_bytes / ranges
    found = sorted(set(_boundaries(rows.withColumn("range", F.lit(0)), F.lit(SAMPLES / share), SAMPLES)))
    while True:
        placed = rows.withColumn("range", range_of(found))
        full = (placed.groupBy("range").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n"))
                .where((F.col("bytes") > FULL * share) & (F.col("n") > 1)).select("range"))
        inside = placed.join(F.broadcast(full), "range", "left_semi")
        more = sorted({*found, *_boundaries(inside, F.lit(SAMPLES / share), SAMPLES // 4)})
        if len(more) == len(found):
            return found
        found = more


def highest_weight(id_col: Column, shards: int) -> Column:
    weights = F.array(*[F.xxhash64(id_col, F.lit(s)) for s in range(shards)])
    return (F.array_position(weights, F.array_max(weights)) - 1).cast("int")


def shard(docs: DataFrame, shards: int = 16, law: str = "bytes", id_col: str = "doc_id", text_col: str = "text",
          range_rows: int = RANGE_ROWS) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot (gapless from 0 in each
    shard), grown_shard for every row of ``docs``."""
    if law not in ("bytes", "rows", "key"):
        raise ValueError(f"unknown law {law!r}")
    text = F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary")
    kind = docs.schema[id_col].dataType
    rows = materialise(docs.select(
        F.col(id_col).isNull().cast("long").alias("last"), F.coalesce(F.col(id_col).cast("long"), F.lit(0)).alias("id"),
        (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("crc"), F.monotonically_increasing_id().alias("row")), "sizes")
    total = rows.agg(F.coalesce(F.sum("size"), F.lit(0)).alias("b"), F.count(F.lit(1)).alias("n")).first()
    cuts = splitters(rows, total.b, total.n, shards, range_rows) if total.n else []
    placed = rows.withColumn("range", range_of(cuts))
    in_range = Window.partitionBy("range").orderBy(*KEY)
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)  # a row for each range
    offsets = placed.groupBy("range").agg(F.sum("size").alias("b"), F.count(F.lit(1)).alias("n")).select(
        "range", F.coalesce(F.sum("b").over(before), F.lit(0)).alias("b0"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("n0"))
    run = placed.withColumn("b", F.sum("size").over(in_range.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size")).withColumn(
        "n", F.row_number().over(in_range) - 1).join(F.broadcast(offsets), "range")
    by_place = {"bytes": F.floor((F.col("b0") + F.col("b")) * shards / F.lit(max(total.b, 1))),
                "rows": F.floor((F.col("n0") + F.col("n")) * shards / F.lit(max(total.n, 1)))}
    id_value = F.when(F.col("last") == 0, F.col("id"))
    chosen = highest_weight(id_value, shards) if law == "key" else F.least(by_place[law], F.lit(shards - 1)).cast("int")
    grown = highest_weight(id_value, shards + 1) if law == "key" else F.lit(None).cast("int")
    done = materialise(run.select(*KEY, "size", "range", chosen.alias("shard"), grown.alias("grown_shard")), "placed")
    parts = Window.partitionBy("shard").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)  # a row for each range
    starts = done.groupBy("shard", "range").agg(F.count(F.lit(1)).alias("n")).select(
        "shard", "range", F.coalesce(F.sum("n").over(parts), F.lit(0)).alias("s0"))
    place = F.row_number().over(Window.partitionBy("range", "shard").orderBy(*KEY)) - 1
    return done.withColumn("place", place).join(starts, ["shard", "range"]).select(
        F.when(F.col("last") == 0, F.col("id")).cast(kind).alias("doc_id"), "size", F.col("crc").alias("text_crc32"), F.lit(law).alias("law"),
        "shard", (F.col("s0") + F.col("place")).alias("slot"), "grown_shard")


def write_shards(docs: DataFrame, path: str, shards: int = 16, law: str = "bytes") -> None:
    """Write ``docs`` to folders shard=k below ``path``.  Rows are matched to
    their shard by id, size and checksum, and repeated rows by number."""
    text = F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")
    same = ["__id", "__size", "__crc"]
    number = F.row_number().over(Window.partitionBy(*same).orderBy(F.lit(0)))
    left = docs.withColumns({"__id": F.col("doc_id").cast("string"), "__size": (F.octet_length(text) + 1).cast("long"), "__crc": F.crc32(text)}).withColumn("__k", number)
    right = shard(docs, shards, law).select(F.col("doc_id").cast("string").alias("__id"), F.col("size").alias("__size"), F.col("text_crc32").alias("__crc"),
                                            F.col("shard").alias("__shard")).withColumn("__k", number)
    on = [left[c].eqNullSafe(right[c]) for c in [*same, "__k"]]
    (left.join(right, on).select(*[left[c] for c in docs.columns], F.col("__shard").alias("shard"))
     .write.partitionBy("shard").parquet(path))
