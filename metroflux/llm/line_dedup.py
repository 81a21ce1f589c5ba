"""Line deduplication by a log-template tree, in DataFrame operations only.

A line's tokens are cut at white space; a token with a digit is a variable
field.  The tree has a fixed depth: number of tokens, then the first
``DEPTH`` tokens.  In a leaf, a later token is constant if at least
``SUPPORT`` different lines of the leaf have it at that place, else it is
generalised to a variable field.  If at least ``SIMILARITY`` of a line's
tokens are constant, the line's template is its constants and their places;
else, if that share has no digit, the line with its digit tokens
generalised; else the line itself.

A template recurs from ``MIN_DOCS`` documents on; all its lines but the first
(smallest id, then line number) are dropped.  Two more rules go by evidence:
a line with a smaller share of constants, but one at least, is also counted
with its digit tokens generalised, and that recurs from ``SPARSE_DOCS``
documents on (page numbers); lines of ``LONG_TOKENS`` or more tokens that are
equal token for token recur from ``LONG_DOCS`` documents on.  Tokens without a
digit are never generalised in the former, or lines of prose with the same
first words would be one template.  A line stays only if it is the first of
each of its templates that recur.

Lines are keyed by hashes in one pass; only lines of leaves with several
different lines are taken apart into tokens, and all counts are aggregated
before they are shuffled.

Defined cases: null and empty texts have no lines; blank lines are always
kept; rows with equal id and text are one document (each row is returned,
with the same result); a null id comes after all others; an empty table
gives an empty result; extra columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from metroflux.llm.common import materialise

DEPTH = 3
SUPPORT = 2
SIMILARITY = 0.7
MIN_DOCS = 3
SPARSE_DOCS = 10
LONG_TOKENS = 20
LONG_DOCS = 2
FIELD = "<*>"


def squeezed(line: Column) -> Column:
    """The line's tokens, joined by one space."""
    odd = F.contains(line, F.lit("  "))
    for c in "\t\x0b\x0c\r":
        odd = odd | F.contains(line, F.lit(c))
    return F.btrim(F.when(odd, F.regexp_replace(line, r"[\x20\x09-\x0D]+", " ")).otherwise(line))


def masked(line: Column) -> Column:
    """Every token with a digit replaced by the field mark."""
    return F.when(line.rlike("[0-9]"), F.regexp_replace(line, r"(?<![^ ])[^ 0-9]*+[0-9][^ ]*", FIELD)).otherwise(line)


def _occurrences(text: Column, part: str) -> Column:
    return F.when(F.contains(text, F.lit(part)), F.octet_length(text) - F.octet_length(F.replace(text, F.lit(part), F.lit("")))).otherwise(0) / len(part)


def line_keys(docs: DataFrame, depth: int = DEPTH) -> DataFrame:
    """Of every line with tokens: document, number, tree leaf, hashes of the
    masked and of the plain tokens, and token counts."""
    lines = docs.where("text <> ''").select("doc_id", "dk", F.posexplode(F.split("text", "\n")).alias("line", "raw"))
    plain = lines.where(F.col("raw").rlike(r"[^\x20\x09-\x0D]")).select("doc_id", "dk", "line", squeezed(F.col("raw")).alias("plain"))
    m = plain.withColumn("m", masked(F.col("plain"))).withColumn("n", (_occurrences(F.col("m"), " ") + 1).cast("int")).withColumn("lead", F.substring_index("m", " ", depth))
    lead = F.col("lead")

    def fields(text: Column) -> Column:
        wide = F.concat(F.lit(" "), F.replace(text, F.lit(" "), F.lit("  ")), F.lit(" "))
        return F.when(F.contains(text, F.lit(FIELD)), _occurrences(wide, f" {FIELD} ")).otherwise(0).cast("int")

    return m.select("doc_id", "dk", "line", "n", F.xxhash64("n", lead).alias("leaf"), F.xxhash64("m").alias("pattern"), F.xxhash64("plain").alias("own"),
                    (F.col("n") - fields(F.col("m"))).alias("plain_tokens"), (F.least(F.col("n"), F.lit(depth)) - fields(lead)).alias("lead_tokens"))


def generalised(docs: DataFrame, keys: DataFrame, depth: int = DEPTH, support: int = SUPPORT, similarity: float = SIMILARITY) -> DataFrame:
    """(leaf, pattern, template) of the patterns that are generalised."""
    patterns = keys.groupBy("leaf", "pattern").agg(F.min(F.struct("doc_id", "dk", "line")).alias("at"), F.max("n").alias("n"), F.max("lead_tokens").alias("lead_tokens"))
    several = patterns.groupBy("leaf").agg(F.count(F.lit(1)).alias("k")).where("k > 1").select("leaf")
    chosen = patterns.where(F.col("n") > depth).join(several, "leaf")
    asked = chosen.groupBy(F.col("at.doc_id").alias("d"), F.col("at.dk").alias("x")).agg(
        F.collect_list(F.struct(F.col("at.line").alias("line"), "leaf", "pattern", "n", "lead_tokens")).alias("asked"))
    copied = docs.groupBy(F.col("doc_id").alias("d"), F.col("dk").alias("x")).agg(F.count(F.lit(1)).alias("rows")).where("rows > 1")
    asked = asked.join(copied, asked["d"].eqNullSafe(copied["d"]) & (asked["x"] == copied["x"]), "left").select(asked["d"], asked["x"], "asked", F.col("rows").isNotNull().alias("copied"))
    found = docs.join(asked, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("dk") == F.col("x"))).withColumn("lines", F.split("text", "\n"))
    line = found.select("copied", F.explode(F.transform("asked", lambda a: F.struct(a["leaf"].alias("leaf"), a["pattern"].alias("pattern"), a["n"].alias("n"), a["lead_tokens"].alias("lead_tokens"),
                                                                           F.element_at("lines", a["line"] + 1).alias("raw")))).alias("a")).select("copied", "a.*")
    tokens = (line.withColumn("m", masked(squeezed(F.col("raw")))).select("copied", "leaf", "pattern", "n", "lead_tokens", F.posexplode(F.split("m", " ")).alias("place", "token"))
              .where((F.col("place") >= depth) & (F.col("token") != FIELD)).select("copied", "leaf", "pattern", "n", "lead_tokens", "place", F.xxhash64("token").alias("token")))
    tokens = materialise(tokens, "tokens")
    tokens = tokens.where("not copied").drop("copied").unionByName(tokens.where("copied").drop("copied").distinct())  # equal rows count once
    constant = tokens.groupBy("leaf", "place", "token").agg(F.count(F.lit(1)).alias("k")).where(F.col("k") >= support).select("leaf", "place", "token")
    kept = tokens.join(constant, ["leaf", "place", "token"]).groupBy("leaf", "pattern").agg(
        F.count(F.lit(1)).alias("k"), F.max("n").alias("n"), F.max("lead_tokens").alias("lead_tokens"), F.bit_xor(F.xxhash64("place", "token")).alias("g"))
    return kept.where(F.col("k") + F.col("lead_tokens") >= F.lit(similarity) * F.col("n")).select(
        "leaf", "pattern", F.xxhash64("leaf", "g", F.lit("template")).alias("template"))


def drop_recurring_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", depth: int = DEPTH, support: int = SUPPORT,
                         similarity: float = SIMILARITY, min_docs: int = MIN_DOCS, sparse_docs: int = SPARSE_DOCS,
                         long_tokens: int = LONG_TOKENS, long_docs: int = LONG_DOCS) -> DataFrame:
    """doc_id, n_lines, n_dropped, kept (the other lines) for every row of
    ``docs``."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).alias("doc_id"), text.alias("text"), F.xxhash64(F.col(id_col), text).alias("dk"))
    keys = materialise(line_keys(rows, depth), "lines")
    # a table of its own, so that a hot pattern's join can be split
    patterns = materialise(generalised(rows, keys, depth, support, similarity), "generalised")
    templates = keys.join(patterns, ["leaf", "pattern"], "left")
    dense, general, long = F.col("plain_tokens") >= F.lit(similarity) * F.col("n"), F.col("template").isNotNull(), F.col("n") >= long_tokens
    plain = F.when(dense, F.xxhash64("pattern", F.lit("pattern"))).otherwise(F.xxhash64("own", F.lit("line")))
    literal = ~general & (~dense | (F.col("plain_tokens") == F.col("n")))
    own = F.struct(F.coalesce("template", plain).alias("template"), F.when(long & literal, long_docs).otherwise(min_docs).alias("need"))
    sparse = F.when(~general & ~dense & (F.col("plain_tokens") > 0), F.struct(F.xxhash64("pattern", F.lit("sparse")).alias("template"), F.lit(sparse_docs).alias("need")))
    equal = F.when(long & ~literal, F.struct(F.xxhash64("own", F.lit("equal")).alias("template"), F.lit(long_docs).alias("need")))
    keyed = templates.select("doc_id", "dk", "line", F.explode(F.array(own, sparse, equal)).alias("key")).where("key IS NOT NULL")
    lines = materialise(keyed.select("doc_id", "dk", "line", "key.template", "key.need"), "templates")
    place = F.struct(F.col("doc_id").isNull().alias("last"), F.col("doc_id").alias("id"), F.col("dk").alias("dk"), F.col("line").alias("line"))
    recurring = (lines.groupBy("template", "need", "doc_id", "dk").agg(F.min("line").alias("line")).groupBy("template", "need")
                 .agg(F.count(F.lit(1)).alias("docs"), F.min(place).alias("first")).where("docs >= need").select("template", "first"))
    recurring = materialise(recurring, "recurring")  # a table of its own, so that a hot template's join can be split
    dropped = (lines.join(recurring, "template").where(place != F.col("first")).groupBy(F.col("doc_id").alias("d"), F.col("dk").alias("x"))
               .agg(F.collect_set("line").alias("drop")))
    joined = rows.join(dropped, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("dk") == F.col("x")), "left")
    parts = joined.withColumn("lines", F.when(F.col("text") != "", F.split("text", "\n")).otherwise(F.array().cast("array<string>")))
    keep = F.array_except(F.when(F.size("lines") > 0, F.sequence(F.lit(0), F.size("lines") - 1)).otherwise(F.array().cast("array<int>")), F.coalesce("drop", F.array().cast("array<int>")))
    kept = F.when(F.col("drop").isNull(), F.col("text")).otherwise(F.array_join(F.transform(keep, lambda i: F.element_at("lines", i + 1)), "\n"))
    return parts.select("doc_id", F.size("lines").cast("long").alias("n_lines"), F.coalesce(F.size("drop"), F.lit(0)).cast("long").alias("n_dropped"), kept.alias("kept"))


ORACLE = r"""
WITH l AS (SELECT doc_id, line, trim(regexp_replace(raw, '[\x20\x09-\x0D]+', ' ', 'g')) AS plain FROM (
    SELECT doc_id, unnest(string_split(text, chr(10))) AS raw, unnest(generate_series(0, len(string_split(text, chr(10))) - 1)) AS line FROM documents WHERE text <> '')),
t AS (SELECT *, string_split(plain, ' ') AS own, list_transform(string_split(plain, ' '), lambda x: CASE WHEN regexp_matches(x, '[0-9]') THEN '<*>' ELSE x END) AS m FROM l WHERE plain <> ''),
p AS (SELECT DISTINCT len(m) AS n, m[1:3] AS lead, m FROM t),
tok AS (SELECT n, lead, m, unnest(m) AS w, unnest(generate_series(1, n)) AS i FROM p),
c AS (SELECT n, lead, i, w FROM tok WHERE i > 3 AND w <> '<*>' GROUP BY ALL HAVING count(*) >= 2),
g AS (SELECT tok.n, tok.lead, m, string_agg(CASE WHEN i <= 3 OR c.w IS NOT NULL THEN tok.w ELSE '<*>' END, ' ' ORDER BY i) AS s,
             count(CASE WHEN tok.w <> '<*>' AND (i <= 3 OR c.w IS NOT NULL) THEN 1 END) AS k
      FROM tok LEFT JOIN c USING (n, lead, i, w) GROUP BY tok.n, tok.lead, m
      HAVING count(CASE WHEN c.w IS NOT NULL THEN 1 END) > 0),
y AS (SELECT *, general OR (dense AND c < n) AS loose FROM (
      SELECT doc_id, line, plain, array_to_string(t.m, ' ') AS ms, g.s, len(t.m) AS n, len(list_filter(t.m, lambda z: z <> '<*>')) AS c,
             coalesce(g.k >= 0.7 * len(t.m), false) AS general, len(list_filter(t.m, lambda z: z <> '<*>')) >= 0.7 * len(t.m) AS dense
      FROM t LEFT JOIN g ON g.m = t.m)),
x AS (SELECT doc_id, line, CASE WHEN general THEN 'g ' || s WHEN dense THEN 'p ' || ms ELSE 'l ' || plain END AS template,
             CASE WHEN n >= 20 AND NOT loose THEN 2 ELSE 3 END AS need FROM y
      UNION ALL SELECT doc_id, line, 's ' || ms, 10 FROM y WHERE NOT general AND NOT dense AND c > 0
      UNION ALL SELECT doc_id, line, 'e ' || plain, 2 FROM y WHERE n >= 20 AND loose),
r AS (SELECT template, min((doc_id, line)) AS head FROM x GROUP BY template HAVING count(DISTINCT doc_id) >= min(need)),
gone AS (SELECT DISTINCT doc_id, line FROM x JOIN r USING (template) WHERE (doc_id, line) <> head),
k AS (SELECT doc_id, count(*) AS n_lines, count(gone.line) AS n_dropped, string_agg(CASE WHEN gone.line IS NULL THEN raw END, chr(10) ORDER BY line) AS kept
      FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS raw, unnest(generate_series(0, len(string_split(text, chr(10))) - 1)) AS line FROM documents WHERE text <> '') a
      LEFT JOIN gone USING (doc_id, line) GROUP BY doc_id)
SELECT doc_id, coalesce(n_lines, 0)::BIGINT AS n_lines, coalesce(n_dropped, 0)::BIGINT AS n_dropped, sha256(coalesce(kept, '')) AS kept_sha256
FROM documents LEFT JOIN k USING (doc_id)
"""
