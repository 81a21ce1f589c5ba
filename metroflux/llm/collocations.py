"""Phrase collocation mining by the stripes pattern.

A stripe belongs to a prefix of words (in one language) and is an
associative counter of the words that come next; the empty prefix's stripe
counts single words.  Tasks count stripes of a block of texts, Spark merges
stripes of one prefix elementwise.  The merged stripe gives all that is
asked of a phrase: an entry is the count of an extension, the stripe's total
(what does not go on counts as the empty word) is the count of the prefix,
and its largest entry is the prefix's subsumption maximum on the right; the
entries seen from their last words give the maximum on the left.

Phrases grow a word a pass over the texts.  A phrase can only reach
``min_count`` if its first and its last words reach it, so a pass counts
entries whose prefix and whose own last words are frequent, by a bitmap of
``BITMAP`` bits (its size does not depend on the corpus; a false hit only
counts a phrase in vain).  A stripe of a prefix that makes up 1/``HEAVY`` of
all words (at most ``HEAVY`` prefixes a pass), and the empty prefix's, is
cut into segments by the hash of the next word, so no task merges the whole
of a hot stripe; merging itself is an aggregation that can spill.

Only the next longer phrases have to be looked at for subsumption: a phrase
between has at least the longer one's count, so it is a candidate too.

Defined cases: a null text is empty, a null language is ``und``; repeated
rows each count; an empty table gives an empty result; other columns are not
read.  Words and phrases are compared as texts; hashes choose only what is
counted at all (no phrase that can be frequent is left out) and where.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from metroflux.llm.common import _byte_table, materialise, mix, sequence_hashes, text_blocks, word_hashes

MIN_COUNT = 30
LONGEST = 4
TOP = 2000
#: a phrase is dropped for a longer one of at least this share of its count
SUBSUMED_PERCENT = 80
SCORE_SCALE = 2_000_000
#: bits of the bitmap of frequent phrases (8 MB)
BITMAP = 1 << 26
#: a prefix of more than 1/HEAVY of all words has its stripe cut
HEAVY = 4096
SEGMENTS = 64
#: segments of the empty prefix's stripe
WORD_SEGMENTS = 1024
#: text bytes of which a task counts stripes at a time
BLOCK = 4 << 20

_PIECE_END = [*range(0x0A, 0x0E), *b".,;:!?"]
#: words [^\x20\x09]+ of pieces, after lower-casing A-Z
WORDS = _byte_table([0x20, 0x09, *_PIECE_END], lower=True)
_ENDS_PIECE = np.zeros(256, dtype=bool)
_ENDS_PIECE[_PIECE_END] = True

STRIPE = "lang string, prefix string, cut boolean, seg int, nexts string, counts string"


def _language_hash(langs: pa.Array) -> np.ndarray:
    return mix(np.array([xxhash.xxh64_intdigest(x, 7) for x in langs.to_pylist()], dtype=np.uint64))


def _in_bitmap(bits: np.ndarray, h: np.ndarray) -> np.ndarray:
    at = (h & np.uint64(8 * len(bits) - 1)).astype(np.int64)
    return (bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1


def _block_stripes(data: np.ndarray, offsets: np.ndarray, lang: np.ndarray, langs: pa.Array, width: int,
                   bits: np.ndarray | None, heavy: np.ndarray, segments: int) -> pa.RecordBatch | None:
    """The stripes of prefixes of ``width`` words in a block of texts;
    ``lang`` is the language number of each text."""
    h, starts, ends, first = word_hashes(data, offsets, WORDS)
    n = len(h)
    if n < max(width, 1):
        return None
    # exact word numbers
    is_word, value = WORDS
    flat = value[data[is_word[data]]]
    at = np.zeros(n + 1, dtype=np.int64)
    np.cumsum(ends - starts, out=at[1:])
    coded = pa.Array.from_buffers(pa.large_string(), n, [None, pa.py_buffer(at), pa.py_buffer(flat)]).dictionary_encode()
    word, vocabulary = coded.indices.to_numpy().astype(np.int64), coded.dictionary.cast(pa.string())
    size = len(vocabulary)
    vocabulary = pa.concat_arrays([vocabulary, pa.array([""])])  # number ``size``: does not go on
    word_hash = np.zeros(size + 1, dtype=np.uint64)
    word_hash[word] = h
    # words that a piece still has from each word on
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
    piece = np.cumsum(_ENDS_PIECE[data])[starts] + text
    last = np.append(np.flatnonzero(np.diff(piece)), n - 1)
    left = last[np.searchsorted(last, np.arange(n))] - np.arange(n) + 1
    of = lang[text]
    if width == 0:
        pos, entry, prefix = np.arange(n), word, of
    else:
        ph = sequence_hashes(h, width) ^ _language_hash(langs)[of[:n - width + 1]]
        frequent = _in_bitmap(bits, ph)
        pos = np.flatnonzero(frequent & (left[:len(ph)] >= width))
        goes_on = left[pos] > width
        goes_on[goes_on] = frequent[pos[goes_on] + 1]
        entry = np.full(len(pos), size, dtype=np.int64)
        entry[goes_on] = word[pos[goes_on] + width]
        prefix = of[pos]
        for d in range(width):
            _, prefix = np.unique(prefix * (size + 1) + word[pos + d], return_inverse=True)
    if not len(pos):
        return None
    key, example, count = np.unique(prefix * (size + 1) + entry, return_index=True, return_counts=True)
    prefix, entry, pos = key // (size + 1), key % (size + 1), pos[example]
    if width == 0:
        cut = np.ones(len(key), dtype=bool)
        seg = (word_hash[entry] % np.uint64(segments)).astype(np.int32)
    else:
        cut = np.isin(ph[pos], heavy)
        seg = np.where(cut, (word_hash[entry] % np.uint64(segments)), 0).astype(np.int32)
    order = np.lexsort((seg, prefix))
    prefix, seg, cut, entry, pos, count = (x[order] for x in (prefix, seg, cut, entry, pos, count))
    stripe = np.flatnonzero(np.concatenate([[True], (prefix[1:] != prefix[:-1]) | (seg[1:] != seg[:-1])]))
    bounds = pa.array(np.append(stripe, len(key)), pa.int32())
    head = pos[stripe]
    words = [vocabulary.take(pa.array(word[head + d])) for d in range(width)]
    nexts = pc.binary_join(pa.ListArray.from_arrays(bounds, vocabulary.take(pa.array(entry))), " ")
    counts = pc.binary_join(pa.ListArray.from_arrays(bounds, pa.array(count).cast(pa.string())), " ")
    return pa.RecordBatch.from_arrays(
        [langs.take(pa.array(of[head])), pc.binary_join_element_wise(*words, " ") if words else pa.array([""] * len(head)),
         pa.array(cut[stripe]), pa.array(seg[stripe]), nexts, counts], ["lang", "prefix", "cut", "seg", "nexts", "counts"])


def stripes(texts: DataFrame, width: int, bits: bytes | None, heavy: list[int], min_count: int) -> DataFrame:
    """The merged stripes (lang, prefix, cut, seg, total, best, entries) of
    all prefixes of ``width`` words that have a frequent entry, and all
    segments of the cut ones; ``entries`` holds the frequent (next, f)."""
    spark = texts.sparkSession
    shared = spark.sparkContext.broadcast((bits, heavy))  # a bitmap of fixed size, at most HEAVY hashes

    segments, block = SEGMENTS if width else WORD_SEGMENTS, BLOCK

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw, hashes = shared.value
        bitmap = None if raw is None else np.frombuffer(raw, dtype=np.uint8)
        hot = np.array(hashes, dtype=np.int64).view(np.uint64)
        for b in batches:
            coded = b.column("lang").dictionary_encode()
            lang, langs = coded.indices.to_numpy().astype(np.int64), coded.dictionary
            for i, j, data, offsets in text_blocks(b.column("text"), block):
                out = _block_stripes(data, offsets, lang[i:j], langs, width, bitmap, hot, segments)
                if out is not None:
                    yield out

    key = ["lang", "prefix", "cut", "seg"]
    # one shuffle by stripe: both aggregations find their rows in place
    dealt = texts.mapInArrow(count, STRIPE).repartition(*key)
    pairs = F.arrays_zip(F.split("nexts", " ").alias("next"), F.split("counts", " ").cast("array<bigint>").alias("n"))
    entries = (dealt.select(*key, F.explode(pairs).alias("e")).groupBy(*key, F.col("e.next").alias("next")).agg(F.sum("e.n").alias("f")))
    frequent = (F.col("f") >= min_count) & (F.col("next") != "")
    merged = entries.groupBy(*key).agg(F.sum("f").alias("total"), F.max(F.when(frequent, F.col("f"))).alias("best"),
                                       F.collect_list(F.when(frequent, F.struct("next", "f"))).alias("entries"))
    return materialise(merged.where(F.col("cut") | F.col("best").isNotNull()), f"stripes-{width}")


def _phrases(merged: DataFrame, width: int) -> DataFrame:
    """The frequent phrases (lang, phrase, f) that end a stripe."""
    flat = merged.select("lang", "prefix", F.explode("entries").alias("e"))
    phrase = F.col("e.next") if width == 0 else F.concat_ws(" ", "prefix", "e.next")
    return flat.select("lang", phrase.alias("phrase"), F.col("e.f").alias("f"))


def _marks(phrases: DataFrame, width: int, least: int) -> tuple[bytes | None, list[int]]:
    """The bitmap of ``phrases`` (of ``width`` words), and the hashes of those
    of count ``least`` or more."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            coded = b.column("lang").dictionary_encode()
            lang_hash = _language_hash(coded.dictionary)[coded.indices.to_numpy()]
            for i, j, data, offsets in text_blocks(b.column("phrase")):
                h, _, _, first = word_hashes(data, offsets, WORDS)
                ph = sequence_hashes(h, width)[first[:-1]] ^ lang_hash[i:j]
                yield pa.RecordBatch.from_arrays([pa.array(ph.view(np.int64)), b.column("f")[i:j]], ["h", "f"])

    marks = materialise(phrases.mapInArrow(hashed, "h bigint, f bigint"), "phrase-marks")
    heavy = [r["h"] for r in marks.where(F.col("f") >= least).select("h").collect()]
    at = F.col("h").bitwiseAND(F.lit(BITMAP - 1))
    page = 1 << 15
    pages = marks.groupBy((F.shiftright(at, 15)).alias("page")).agg(F.bitmap_construct_agg(at.bitwiseAND(F.lit(page - 1))).alias("bits")).collect()
    if not pages:
        return None, []
    bits = bytearray(BITMAP // 8)
    for p in pages:  # at most BITMAP / 2**15 pages of 4 KB
        bits[p["page"] * page // 8:(p["page"] + 1) * page // 8] = p["bits"]
    return bytes(bits), heavy


def _whole(c: str | Column) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("decimal(20,0)")


def collocations(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", min_count: int = MIN_COUNT, longest: int = LONGEST,
                 top: int = TOP, percent: int = SUBSUMED_PERCENT) -> DataFrame:
    """The first ``top`` phrases of each language: lang, rank, phrase, a, l,
    r, n, score."""
    texts = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.col(text_col).cast("string").alias("text"))
    levels = [stripes(texts, 0, None, [], min_count)]
    words = materialise(levels[0].groupBy("lang").agg(F.sum("total").alias("n")), "language-words")
    everything = words.agg(F.sum(_whole("n")).alias("n")).first()["n"] or 0
    phrases = _phrases(levels[0], 0)
    for width in range(1, longest):
        bits, heavy = _marks(_phrases(levels[-1], width - 1), width, max(1, -(-int(everything) // HEAVY)))
        if bits is None:
            break
        levels.append(stripes(texts, width, bits, heavy, min_count))
        phrases = phrases.unionByName(_phrases(levels[-1], width))
    phrases = materialise(phrases, "phrases")
    totals, right = None, None
    for width, merged in enumerate(levels[1:], 1):
        one = merged.groupBy("lang", "prefix").agg(F.sum("total").alias("l"), F.max("best").alias("longer"))
        totals = one if totals is None else totals.unionByName(one)
    none = phrases.limit(0).select("lang", F.col("phrase").alias("prefix"), F.col("f").alias("l"), F.col("f").alias("longer"))
    totals = materialise(none if totals is None else totals, "prefix-totals")

    length = F.size("words")
    split = phrases.select("lang", "phrase", F.col("f").alias("a"), F.split("phrase", " ").alias("words"))
    left = split.where(length > 2).select("lang", F.array_join(F.slice("words", F.lit(2), length - 1), " ").alias("inner"), F.col("a").alias("longer"))
    right = totals.where("longer is not null").select("lang", F.col("prefix").alias("inner"), "longer")
    maxima = materialise(left.unionByName(right).groupBy("lang", "inner").agg(F.max("longer").alias("longer")), "longer")

    candidates = split.where(length > 1)
    alone = candidates.join(maxima, (candidates["lang"] == maxima["lang"]) & (candidates["phrase"] == maxima["inner"]), "left").where(
        F.col("longer").isNull() | (F.lit(100) * _whole("longer") < F.lit(percent) * _whole("a"))).select(candidates["lang"], "phrase", "a", "words")
    cuts = alone.select("lang", "phrase", "a", "words", F.explode(F.sequence(F.lit(1), length - 1)).alias("k")).select(
        "lang", "phrase", "a", "k", F.array_join(F.slice("words", F.lit(1), F.col("k")), " ").alias("first"),
        F.array_join(F.slice("words", F.col("k") + 1, length), " ").alias("rest"))
    # both looked-up tables are stored: a hot first or last part is split by adaptive execution
    cuts = materialise(cuts.join(totals.select("lang", F.col("prefix").alias("first"), "l"), ["lang", "first"]), "cuts")
    cuts = cuts.join(phrases.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r")), ["lang", "rest"])
    score = F.expr(f"cast((cast({SCORE_SCALE} as decimal(18,0)) * cast(a as decimal(20,0))) div (cast(l as decimal(20,0)) + cast(r as decimal(20,0))) as bigint)")
    best = cuts.groupBy("lang", "phrase").agg(F.min(F.struct(score.alias("score"), "k", "l", "r", "a")).alias("b")).select(
        "lang", "phrase", "b.a", "b.l", "b.r", "b.score")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # ranks are places in ranges of the order plus the ranges' sizes before them
    ranges = materialise(best.repartitionByRange("lang", *order).withColumn("range", F.spark_partition_id()), "ranges")
    sizes = ranges.groupBy("lang", "range").agg(F.count(F.lit(1)).alias("size"))
    before = F.sum("size").over(Window.partitionBy("lang").orderBy("range").rowsBetween(Window.unboundedPreceding, -1))
    sizes = materialise(sizes.select("lang", "range", F.coalesce(before, F.lit(0)).alias("before")).where(F.col("before") < top), "range-sizes")
    place = F.row_number().over(Window.partitionBy("lang", "range").orderBy(*order))
    ranked = (ranges.join(sizes, ["lang", "range"]).withColumn("rank", (place + F.col("before")).cast("bigint")).where(F.col("rank") <= top))
    return ranked.join(words, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


ORACLE = f"""
WITH pieces AS (SELECT row_number() OVER () AS piece, lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM (
       SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
              '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents)),
f AS MATERIALIZED (SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase, count(*) AS f
       FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM pieces, range(1, {LONGEST + 1}) t(k)) GROUP BY ALL),
total AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f WHERE k = 1 GROUP BY lang),
c AS MATERIALIZED (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE k > 1 AND f >= {MIN_COUNT}),
inside AS (SELECT lang, array_to_string(w[i:j], ' ') AS phrase, max(a) AS longer
       FROM (SELECT lang, w, a, k, i, unnest(range(i + 1, k + 1)) AS j FROM (SELECT *, unnest(range(1, k)) AS i FROM c)) WHERE j - i + 1 < k GROUP BY ALL),
cuts AS (SELECT c.lang, c.phrase, a, cut, x.f AS l, y.f AS r, CAST(CAST({SCORE_SCALE} AS HUGEINT) * a // (x.f + y.f) AS BIGINT) AS score
       FROM (SELECT *, unnest(range(1, k)) AS cut FROM c) c JOIN f x ON x.lang = c.lang AND x.phrase = array_to_string(w[1:cut], ' ')
       JOIN f y ON y.lang = c.lang AND y.phrase = array_to_string(w[cut + 1:], ' ')),
best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1)
SELECT b.lang, row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, a DESC, b.phrase) AS rank, b.phrase, a, l, r, n, score
FROM best b LEFT JOIN inside i ON b.lang = i.lang AND b.phrase = i.phrase JOIN total t ON b.lang = t.lang
WHERE longer IS NULL OR 100 * longer < {SUBSUMED_PERCENT} * a QUALIFY rank <= {TOP}
"""
