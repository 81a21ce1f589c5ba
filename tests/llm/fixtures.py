"""Small tables with the defined cases: nulls, empty and long texts, ties,
repeated rows, extra columns with clashing names."""

import random

DOCS = "doc_id long, text string, lang string, source string, n_chars long, digest string, node string, size long, k int"
WORDS = [a + b for a in ("ka", "lo", "mi", "nu", "re", "so") for b in ("ta", "vu", "wi", "xe", "yo", "za", "li", "mo")]


def sentence(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n))


def rows(seed=0, n=60):
    """(doc_id, text) pairs: prose, copies, near copies, shared passages,
    white-space variants, and the odd cases."""
    rng = random.Random(seed)
    base = [sentence(rng, rng.randint(30, 120)) for _ in range(n)]
    passage, out = sentence(rng, 45), []
    for i, t in enumerate(base):
        kind = i % 6
        w = t.split()
        if kind == 1:
            t = base[i - 1]
        elif kind == 2:
            t = base[i - 2].replace(" ", "  \t", 3)
        elif kind == 3:
            w = base[i - 3].split()
            w[rng.randrange(len(w))] = "CHANGED"
            t = " ".join(w)
        elif kind == 4:
            t = " ".join(w[:15]) + " " + passage + " " + " ".join(w[15:])
        out.append((1000 - 7 * i, t))
    big = sentence(rng, 30_000)
    out += [(3, None), (4, ""), (5, " \t\n "), (6, "one"), (7, "One"), (8, "two words"), (9, big), (10, big + " end"), (11, big),
            (12, "12345 !!! ???"), (None, base[0]), (None, None), (1000, base[0]), (1000, base[0]), (13, "é ü ñ 日本語 text"), (14, "the a b c"),
            (15, passage + " " + passage), (16, sentence(rng, 20)), (17, "x " * 50)]
    return out


def frame(spark, pairs):
    return spark.createDataFrame([(i, t, "en", "s", 1, "d", "n", 5, 6) for i, t in pairs], DOCS)


def records(df):
    return [tuple(r) for r in df.collect()]
