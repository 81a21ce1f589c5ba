"""Text helpers with the platform's exact string rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values: patterns ---------------------------------------------------
PARTITION_UNSAFE = r"[^A-Za-z0-9._-]+"
UNICODE_SPACE_EDGES = r"^\s+|\s+$"


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --- fixed values: Unicode White_Space characters (what Go's TrimSpace strips)
WHITE_SPACE = ("\t\n\x0b\x0c\r \x85\xa0\u1680"
               + "".join(chr(c) for c in range(0x2000, 0x200B)) + "\u2028\u2029\u202f\u205f\u3000")


def go_trim(c) -> Column:
    """Strip leading/trailing Unicode white space (Spark ``trim`` strips only
    ASCII spaces); ``btrim`` with the character set, no regex."""
    return F.btrim(col_(c), F.lit(WHITE_SPACE))


def is_blank(c) -> Column:
    """NULL, empty or only Unicode white space."""
    return F.coalesce(go_trim(c), F.lit("")) == ""


def partition_value(c) -> Column:
    """Runs of characters outside ``[A-Za-z0-9._-]`` become ``_``; empty -> unknown."""
    safe = F.regexp_replace(F.coalesce(col_(c), F.lit("")), PARTITION_UNSAFE, "_")
    return F.when(safe == "", F.lit("unknown")).otherwise(safe)


def normalize_unit(c) -> Column:
    """lower, drop (ASCII) spaces, micro signs -> u, superscript three -> 3."""
    return F.translate(F.replace(F.lower(go_trim(c)), F.lit(" "), F.lit("")), "µμ³", "uu3")


def lookup(key: Column, mapping: dict, default: Column | None = None) -> Column:
    """Value of ``key`` in a literal map (NULL / ``default`` when absent).

    One map literal instead of a CASE chain: the key expression appears once
    in the tree, however many entries the catalogue has."""
    m = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    v = F.try_element_at(m, key)
    return v if default is None else F.coalesce(v, default)


def pick(index: Column, values: list) -> Column:
    """``values[index]`` (0-based) from a literal array."""
    return F.try_element_at(F.array(*[F.lit(v) for v in values]), index.cast("int") + 1)
