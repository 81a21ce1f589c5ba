"""Exact deduplication with a heavy-hitter split.

Texts are equal when identical after each white-space run is replaced by
one space; equality is decided on the SHA-256 of that text.  Misra-Gries
summaries (``k`` counters per task, merged to ``k``) find the digests that
can hold more than 1/k of the rows; their exact counts and winners are
verified by one pre-aggregated pass and broadcast (at most ``k`` rows), so
rows of heavy digests are decided in the map tasks.  What is left goes
through an ordinary shuffle of (digest, id).

Defined cases: a null text counts as empty; a null id sorts after every
other id; of repeated rows (same id, same text) one stays; an empty table
gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from metroflux.llm.common import keep_rows, materialise, scratch

SPACES = r"[\x20\x09-\x0D]+"
K = 1024


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text.cast("string"), F.lit("")), SPACES, " ")


def digest(text: Column) -> Column:
    return F.sha2(normalised(text).cast("binary"), 256)


def _shrink(counts: dict, k: int) -> dict:
    """The Misra-Gries step: subtract the (k+1)-th largest count."""
    if len(counts) <= k:
        return counts
    cut = sorted(counts.values(), reverse=True)[k]
    return {d: c - cut for d, c in counts.items() if c > cut}


def misra_gries(digests: DataFrame, k: int = K) -> DataFrame:
    """Frequent values (digest, weight) of column ``digest``, at most ``k``
    rows.  Every task's summary holds each value of more than 1/(k+1) of its
    rows; the merge keeps the k values of most summed weight, which is a good
    choice but no promise, and nothing rests on it: what is not named here
    goes the ordinary way."""

    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict = {}
        for b in batches:
            seen = pc.value_counts(b.column(0))
            for d, c in zip(seen.field("values").to_pylist(), seen.field("counts").to_pylist(), strict=True):
                counts[d] = counts.get(d, 0) + c
            counts = _shrink(counts, k)
        yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], ["digest", "weight"])

    parts = digests.select("digest").mapInArrow(summarise, "digest string, weight long")
    merged = parts.groupBy("digest").agg(F.sum("weight").alias("weight"))
    return merged.where("weight > 1").orderBy(F.desc("weight"), "digest").limit(k)


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = K) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept,
    text_sha256."""
    rows = materialise(docs.select(F.col(id_col).alias("doc_id"), digest(F.col(text_col)).alias("digest"),
                                   F.monotonically_increasing_id().alias("row")), "digests")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("last"), F.col("doc_id").alias("id"), F.col("row").alias("row")))
    candidates = misra_gries(rows, k).select("digest")
    verified = (rows.join(F.broadcast(candidates), "digest").groupBy("digest")
                .agg(first.alias("first"), F.count(F.lit(1)).alias("n")))
    heavy = materialise(verified.where("n > 1"), "heavy")  # at most k rows
    by_digest = Window.partitionBy("digest")
    split = rows.join(F.broadcast(heavy), "digest", "left")
    hot = split.where("n is not null")
    cold = (rows.join(F.broadcast(heavy.select("digest")), "digest", "left_anti")
            .select("digest", "doc_id", "row", first.over(by_digest).alias("first"), F.count(F.lit(1)).over(by_digest).alias("n")))
    return hot.select(cold.columns).unionByName(cold).select(
        "doc_id", F.col("first.id").alias("keep_id"), F.col("n").alias("group_size"),
        (F.col("row") == F.col("first.row")).alias("kept"), F.col("digest").alias("text_sha256"))


def drop_exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = K) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns: the texts are
    read where they are, and only rows that go are named."""
    with scratch() as keep:
        rows = materialise(exact_duplicates(docs, id_col, text_col, k).where("not kept"), "duplicates")
        winner = F.col("doc_id").eqNullSafe(F.col("keep_id"))
        keys = rows.select("doc_id", F.col("text_sha256").alias("key"), winner.alias("winner"))
        gone = keep(materialise(keys.where("not winner").select("doc_id", "key").distinct(), "gone"))
        repeated = keep(materialise(keys.where("winner").select("doc_id", "key").distinct(), "repeated"))
    return keep_rows(docs, id_col, digest(F.col(text_col)), gone, repeated)


ORACLE = """
WITH n AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]+', ' ', 'g')) AS text_sha256 FROM documents)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = min(doc_id) OVER w AS kept, text_sha256
FROM n WINDOW w AS (PARTITION BY text_sha256)
"""
