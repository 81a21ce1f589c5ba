"""N-gram Jaccard join over count vectors and R-trees.

A document's set is its distinct shingles of ``width`` words (64-bit hashes);
two documents link when 100 * |intersection| >= ``percent`` * |union|.  The
defaults, 3 words and 90, are op4's rule.

Points.  Shingles are hashed into groups, and a document is the vector of
its group counts.  The overlap of two documents is at most the sum of the
coordinate minima, and their symmetric difference is at most t = (|A| +
|B|) (100 - percent) / (100 + percent) when they link.

Routing.  The vector of a size class (sizes within a factor ``STEP``; a
document that can link upwards also stands in the next class) is cut into
t + 1 slabs, so linked documents agree on all counts of at least one slab.
Equal (class, slab, counts) is a cell; a slab has so many groups that unlike
shingles hardly ever give equal counts.  A slab with fewer than
``FEW`` shingles tells little, so its cell is an R-tree over the documents'
coarser vectors, whose pages are pruned by the bound; the rectangle of what a
task has linked stands for it in the shuffle.  The other cells link as they
are: they go from the texts straight to the shuffle, with the place of their
node in what its task sent.  Equal sets are one node throughout, and a task
sends a cell once.

Verification.  Connected cells make blocking groups (supersets of the
result's components).  Each group's texts meet in one task, where an R-tree
over the vectors gives the pairs that pass the bound and the sets decide;
documents already linked to the same component are not compared again.  A
group of more than ``PART_BYTES`` or ``PART_ROWS`` is routed once more by the
finer plan of slabs, which parts what shares a passage only.  If it is still too
large it is cut in parts, each linked inside itself first.  Then the heads of the group's ``HEADS`` largest components
visit all its parts, which joins what belongs to a large group of copies; last,
the documents that are not in the group's largest component by then visit all
parts.  Visitors come in rounds that store no more than the groups have (or
``ROUND_BYTES``) and stream past a part, so a task holds one part at a time, and
no two members of the largest component are compared across parts.  The
result is the connected components of the verified links.

Words: A-Z lower-cased, ``[^\\x20\\x09-\\x0D]+``, whole texts; with fewer than
``width`` words the whole sequence is the one shingle.

Defined cases: null, empty and blank texts have the empty set, link with
nothing and are their own component; a null id does not name a component
unless all its documents have none; repeated rows are linked; extra columns
are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from hashlib import blake2b
from itertools import combinations, groupby, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from metroflux.llm.common import LOWER_WORDS, discard, keep_rows, likely_rows, materialise, mix, outlive, scratch, text_blocks, word_hashes
from metroflux.llm.components import connected_components

SHINGLE = 3
PERCENT = 90
STEP = 1.15
FEW = 3
CELL_GROUP = 1_500_000
#: telling cells that a task sends at a time, more or less, and documents, at most 65,536
SEND_CELLS = 500_000
SEND_ROWS = 1 << 15
#: bytes of a cell's label that are sent, of 8 (its group tells the rest, or nearly)
LABEL_BYTES = 6
PART_BYTES = 8 << 20
PART_ROWS = 16384
#: bytes of visitors that are dealt to parts at a time, if the groups have no more
ROUND_BYTES = 128 << 20
#: components of a cut group whose heads visit all its parts (a short cut: what they miss is compared after)
HEADS = 16
#: groups of the vectors that texts are compared by in a task, at most (fewer make a weaker bound, no other result)
MOST_GROUPS = 1024
#: visitors of a part that a task holds at a time
VISITORS = 256
LEAF = 32

_U = [0]
while _U[-1] < 1 << 40:
    _U.append(max(_U[-1] + 1, int(_U[-1] * STEP)))
#: largest size of each class
UPPER = np.array(_U, dtype=np.int64)


def links(overlap, a, b, percent: int = PERCENT):
    """The join's rule on set sizes and the size of their intersection."""
    return 100 * overlap >= percent * (a + b - overlap)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, width: int = SHINGLE) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    h, _, _, first = word_hashes(data, offsets, LOWER_WORDS)
    factor = [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, *(int(x) | 1 for x in mix(np.arange(1, max(width - 2, 1), dtype=np.uint64)))]
    s = np.zeros(max(len(h) - width + 1, 0), dtype=np.uint64)
    for k in range(width):
        s += h[k:len(s) + k] * np.uint64(factor[k])
    s = mix(s)
    for i in range(len(offsets) - 1):
        lo, hi = int(first[i]), int(first[i + 1])
        if hi - lo >= width:
            yield np.unique(s[lo:hi - width + 1])
        elif hi > lo:  # fewer words: the sequence is one shingle
            total = np.array([hi - lo], dtype=np.uint64)
            for k in range(lo, hi):
                total = mix(h[k:k + 1] + total * np.uint64(factor[1]))
            yield total
        else:
            yield np.zeros(0, dtype=np.uint64)


def node_of(s: np.ndarray) -> bytes:
    """128-bit name of a set."""
    return mix(np.array([s.sum(), mix(s ^ np.uint64(0x94D049BB133111EB)).sum()], dtype=np.uint64) + np.uint64(len(s))).tobytes()


def count_vector(s: np.ndarray, groups: int) -> np.ndarray:
    """Counts of the set's hashes in ``groups`` groups (a power of two)."""
    return np.bincount((s >> np.uint64(64 - groups.bit_length() + 1)).astype(np.int64), minlength=groups).astype(np.uint16)


def vector_groups(size: int) -> int:
    """Groups of the vectors that sets of up to ``size`` are compared by."""
    return 1 << max(4, (max(size, 1) // 8).bit_length())


def classes(n: int, percent: int = PERCENT) -> list[int]:
    own = int(np.searchsorted(UPPER, n))
    most = int(np.searchsorted(UPPER, 100 * n // percent))  # class of the largest set it can link with
    return list(range(own, most + 1))


def slab_plan(percent: int, finer: bool = False) -> tuple[float, int, int, int]:
    """(slabs for each one that the differences of linked sets can spoil at
    most, neighbouring slabs that are a block, slabs of a block that are a cell,
    shingles from which a cell tells enough).

    At a high similarity slabs are large, and few of them tell little.  At a
    lower one they are smaller; with half as many again and a lower bar, the
    equal ones outnumber those that tell little in nearly every set.  The finer
    plan takes any three slabs of five: unlike texts that share a passage
    hardly ever agree on so many shingles, at three times the cells."""
    if finer:
        return 2.0, 5, 3, FEW
    return (1.0, 1, 1, FEW) if percent >= 90 else (1.5, 1, 1, 2)


def cells(s: np.ndarray, percent: int = PERCENT, finer: bool = False) -> tuple[np.ndarray, list[tuple[int, int]]]:
    """Cells of a set: hashes of the telling ones, (hash, class) of the
    others.

    Two sets that link differ in at most ``away`` shingles, each of which
    spoils one slab.  A set whose telling cells outlast any ``away`` spoiled
    slabs shares one with every partner, and its others need not be looked at:
    those are single slabs, of which two linked sets agree on one."""
    telling, others = [], []
    spread, block, take, few = slab_plan(percent, finer)
    for c in classes(len(s), percent):
        most = 2 * int(UPPER[c]) * (100 - percent) // (100 + percent)
        if most == 0:
            continue  # so small that only equal sets link
        slabs = -(-int(spread * (most + 1)) // block) * block
        away = (len(s) + min(int(UPPER[c]), 100 * len(s) // percent)) * (100 - percent) // (100 + percent)
        place = mix(s ^ np.uint64(0xA24BAED4963EE407 + block)) >> np.uint64(20)  # 44 bits: the slab, and one of its groups
        slab = (place % np.uint64(slabs)).astype(np.int64)
        # the counts of a slab's groups, as one value: a sum of the groups' random weights
        value = np.zeros(slabs, dtype=np.uint64)
        np.add.at(value, slab, mix((place + np.uint64(1)) * np.uint64(0x9FB21C651E98DF25)))
        size = np.bincount(slab, minlength=slabs)
        cell = mix(value + np.arange(slabs, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95) + np.uint64(c << 48))
        cell_of, size_of = cell.reshape(-1, block), size.reshape(-1, block)
        for some in combinations(range(block), take):
            tells = size_of[:, some].sum(axis=1) >= few
            name = cell_of[tells][:, some]
            telling.append(name[:, 0] if take == 1 else mix((name * np.arange(1, 2 * take, 2, dtype=np.uint64)).sum(axis=1)))
        # slabs of a block that must be spoiled until none of its cells is left
        by_size = np.sort(size_of, axis=1)
        outlast = sum(np.count_nonzero(by_size[:, k - take:k].sum(axis=1) >= few) for k in range(take, block + 1))
        if outlast <= away:
            rest = cell[size < few] if take == 1 else mix(cell[:most + 1])
            others += [(int(x), c) for x in rest.view(np.int64)]
    return (np.concatenate(telling) if telling else np.zeros(0, dtype=np.uint64)), others


class CountTree:
    """R-tree over rectangles of count vectors (points are rectangles of no
    extent).  ``low`` is not needed: a page's bound is the sum of minima with
    its upper corner and its least set size."""

    def __init__(self, high: np.ndarray, size: np.ndarray, percent: int = PERCENT):
        self.high, self.size, self.percent = high.astype(np.int32), size.astype(np.int64), percent
        order, spread = np.arange(len(size)), [np.arange(len(size))]
        while spread and len(spread[0]) > LEAF:  # halve every page along its widest coordinate
            out = []
            for page in spread:
                v = self.high[page]
                by = page[np.argsort(v[:, int(np.argmax(v.max(axis=0) - v.min(axis=0)))], kind="stable")]
                out += [by[:len(by) // 2], by[len(by) // 2:]]
            spread = out
        self.pages = spread if len(order) else []
        self.page_high = np.stack([self.high[p].max(axis=0) for p in self.pages]) if self.pages else self.high
        self.page_size = np.array([self.size[p].min() for p in self.pages], dtype=np.int64)
        self.open = np.ones(len(size), dtype=bool)
        self.left = np.array([len(p) for p in self.pages], dtype=np.int64)
        self.page_of = np.zeros(len(size), dtype=np.int64)
        for k, p in enumerate(self.pages):
            self.page_of[p] = k

    def close(self, points: np.ndarray) -> None:
        points = points[self.open[points]]
        self.open[points] = False
        np.subtract.at(self.left, self.page_of[points], 1)

    def search(self, high: np.ndarray, size: int) -> np.ndarray:
        """Open entries that may link with the rectangle."""
        some = np.flatnonzero(self.left > 0)
        bound = np.minimum(self.page_high[some], high).sum(axis=1)
        some = some[links(bound, self.page_size[some], size, self.percent)]
        if not len(some):
            return np.zeros(0, dtype=np.int64)
        at = np.concatenate([self.pages[k] for k in some.tolist()])
        at = at[self.open[at]]
        return at[links(np.minimum(self.high[at], high).sum(axis=1), self.size[at], size, self.percent)]


def linked(high: np.ndarray, size: np.ndarray, test=None, percent: int = PERCENT) -> np.ndarray:
    """Component number of every entry, by growing one component at a time:
    only entries that belong to none yet are searched for.  ``test(p, at)``
    decides the survivors of the bound (None: all link)."""
    tree, component = CountTree(high, size, percent), np.full(len(size), -1, dtype=np.int64)
    for seed in range(len(size)):
        if component[seed] >= 0:
            continue
        component[seed], queue = seed, [seed]
        tree.close(np.array([seed]))
        while queue:
            p = queue.pop()
            at = tree.search(tree.high[p], int(size[p]))
            if len(at) and test is not None:
                at = at[test(p, at)]
            if len(at):
                component[at] = seed
                tree.close(at)
                queue += at.tolist()
    return component


def row_key(id_col: str, text_col: str) -> Column:
    return F.xxhash64(F.col(id_col), F.col(text_col))


def document_sets(docs: DataFrame, id_col: str, text_col: str, width: int = SHINGLE, percent: int = PERCENT, finer: bool = False) -> DataFrame:
    """doc_id, key, n, node, number of telling cells and other cells of every
    row; a task gives the cells of a node once in a while only."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        for b in batches:
            for i, j, data, offsets in text_blocks(b.column(1)):
                out = ([], [], [], [])
                for s in shingle_sets(data, offsets, width):
                    node = node_of(s)
                    telling, few = (np.zeros(0, np.uint64), []) if node in seen or not len(s) else cells(s, percent, finer)
                    if len(seen) > 1_000_000:
                        seen.clear()
                    seen.add(node)
                    out[0].append(len(s))
                    out[1].append(node)
                    out[2].append(len(telling))
                    out[3].append([{"cell": x, "class": c, "size": len(s), "high": count_vector(s, vector_groups(int(UPPER[c]))).tobytes()} for x, c in few])
                kind = pa.list_(pa.struct([("cell", pa.int64()), ("class", pa.int32()), ("size", pa.int64()), ("high", pa.binary())]))
                yield pa.RecordBatch.from_arrays([*[b.column(c).slice(i, j - i) for c in (0, 2)], pa.array(out[0], pa.int64()), pa.array(out[1], pa.binary()), pa.array(out[2], pa.int64()), pa.array(out[3], kind)],
                                                 ["doc_id", "key", "n", "node", "telling", "few"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(docs[id_col], docs[text_col].cast("string"), row_key(id_col, text_col).alias("key")).mapInArrow(
        run, f"doc_id {kind}, key long, n long, node binary, telling long, few array<struct<cell: long, class: int, size: long, high: binary>>")


def _heads(label: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(order, head, of): an order with equal labels together, the first
    place of each run, and the head's place for every place."""
    order = np.argsort(label)
    ordered = label[order]
    new = np.concatenate([[True], ordered[1:] != ordered[:-1]]) if len(label) else np.zeros(0, bool)
    head = np.flatnonzero(new)
    return order, head, np.repeat(head, np.diff(np.append(head, len(label))))


def _stars(who: np.ndarray, n: int, order: np.ndarray, of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (place, head's place) of what shares a label with its head;
    ``who`` gives the places, below ``n``, of the labels that ``_heads`` ordered."""
    rest = np.flatnonzero(np.arange(len(order)) != of)
    return np.divmod(np.unique(who[order[rest]].astype(np.int64) * n + who[order[of[rest]]]), max(n, 1))


_SENT = "grp int, batch long, at binary, cells binary, nodes binary"


def _sent(nodes: list[bytes], found: list[np.ndarray], groups: int) -> Iterator[tuple]:
    """Rows of ``_SENT`` for a batch of nodes and the telling cells of each:
    the batch's nodes, once, with a star of its own for each cell that some of
    them share; and for every group of cells, their labels and the places in
    the batch of the nodes that have them.  So a cell takes the same bytes in
    however many groups a node's cells lie."""
    blob = b"".join(nodes)
    batch = int.from_bytes(blake2b(blob, digest_size=8).digest(), "little", signed=True)
    label, who = np.concatenate(found), np.repeat(np.arange(len(nodes)), [len(x) for x in found])
    order, head, of = _heads(label)
    a, b = _stars(who, len(nodes), order, of)
    yield batch % groups, batch, np.stack([a, b], axis=1).astype(np.uint16).tobytes(), b"", blob
    first = order[head]
    grp = (label[first] % np.uint64(groups)).astype(np.int64)
    by = np.lexsort((first, grp))
    first, grp = first[by], grp[by]
    short = (label[first] // np.uint64(groups)).view(np.uint8).reshape(-1, 8)[:, :LABEL_BYTES]
    cuts = np.flatnonzero(np.diff(grp, prepend=-1)).tolist()
    for i, j in zip(cuts, [*cuts[1:], len(first)], strict=True):
        yield int(grp[i]), batch, who[first[i:j]].astype(np.uint16).tobytes(), short[i:j].tobytes(), None


def _meet(rows: list[tuple[int, bytes, bytes]]) -> tuple[np.ndarray, ...]:
    """Distinct links (batch, place, other batch, other place) of the nodes
    that share a cell in one group: (batch, places, labels) of each batch."""
    held = np.frombuffer(b"".join(r[2] for r in rows), np.uint8).reshape(-1, LABEL_BYTES)
    label = np.zeros((len(held), 8), dtype=np.uint8)
    label[:, :LABEL_BYTES] = held
    places = [np.frombuffer(r[1], np.uint16).astype(np.int64) for r in rows]
    base = np.cumsum([0, *[int(x.max()) + 1 for x in places]])
    order, _, of = _heads(label.view(np.uint64).ravel())
    batch, out = np.array([r[0] for r in rows], dtype=np.int64), []
    for x in _stars(np.concatenate([x + b for x, b in zip(places, base[:-1], strict=True)]), int(base[-1]), order, of):
        k = np.searchsorted(base, x, side="right") - 1
        out += [batch[k], (x - base[k]).astype(np.int32)]
    return tuple(out)


def telling_edges(docs: DataFrame, text_col: str, total: int, width: int = SHINGLE, percent: int = PERCENT, finer: bool = False) -> DataFrame:
    """Edges (a, b) between nodes that share a telling cell, of which there are
    ``total`` or so: a star in every batch that a task sends, and one of its
    nodes in the cell's group.  The cells are hashed from the texts once more
    and go straight to the shuffle; stored, they would be larger than the texts."""
    groups = int(total // CELL_GROUP) + 1
    names = [x.split()[0] for x in _SENT.split(", ")]
    kinds = [pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary()]

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        nodes, found, size = [], [], 0

        def flush():
            rows = list(_sent(nodes, found, groups))
            return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)

        for b in batches:
            for _, _, data, offsets in text_blocks(b.column(0)):
                for s in shingle_sets(data, offsets, width):
                    node = node_of(s)
                    if node in seen or not len(s):
                        continue
                    if len(seen) > 1_000_000:
                        seen.clear()
                    seen.add(node)
                    telling = cells(s, percent, finer)[0]
                    if not len(telling):
                        continue
                    nodes.append(node)
                    found.append(telling)
                    size += len(telling)
                    if size >= SEND_CELLS or len(nodes) >= SEND_ROWS:
                        yield flush()
                        nodes, found, size = [], [], 0
        if nodes:
            yield flush()

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def links_of(a, at, b, bt):
            return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(at, pa.int32()), pa.array(b, pa.int64()), pa.array(bt, pa.int32()), pa.nulls(len(a), pa.binary())], ["a", "at", "b", "bt", "nodes"])

        for _, rows in groupby(_rows(batches), key=lambda r: r[0]):
            held = []
            for _, batch, at, labels, nodes in rows:
                if nodes is None:
                    held.append((batch, at, labels))
                    continue
                pair = np.frombuffer(at, np.uint16).reshape(-1, 2)
                own = np.full(len(pair), batch, dtype=np.int64)
                yield links_of(own, pair[:, 0], own, pair[:, 1])
                yield pa.RecordBatch.from_arrays([pa.array([batch], pa.int64()), pa.nulls(1, pa.int32()), pa.nulls(1, pa.int64()), pa.nulls(1, pa.int32()), pa.array([nodes], pa.binary())], ["a", "at", "b", "bt", "nodes"])
            if held:
                yield links_of(*_meet(held))

    def name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, nodes in _rows(batches):
            each = [nodes[k:k + 16] for k in range(0, len(nodes), 16)]
            yield pa.RecordBatch.from_arrays([pa.array([batch] * len(each), pa.int64()), pa.array(range(len(each)), pa.int32()), pa.array(each, pa.binary())], ["batch", "place", "node"])

    met = materialise(docs.select(F.col(text_col).cast("string")).mapInArrow(send, _SENT).repartitionById(groups, "grp").sortWithinPartitions("grp")
                      .mapInArrow(meet, "a long, at int, b long, bt int, nodes binary"), "met")
    named = met.where("nodes is not null").select("a", "nodes").mapInArrow(name, "batch long, place int, node binary")
    pairs = met.where("nodes is null").select("a", "at", "b", "bt").distinct()
    ends = [named.select(F.col("batch").alias(x), F.col("place").alias(y), F.col("node").alias(z)).distinct() for x, y, z in (("a", "at", "from"), ("b", "bt", "to"))]
    return pairs.join(ends[0], ["a", "at"]).join(ends[1], ["b", "bt"]).select(F.col("from").alias("a"), F.col("to").alias("b"))


_PAGE = "cell long, class int, size long, node binary, high binary"


def _link_cells(rows: Iterator[dict], percent: int) -> Iterator[tuple[dict, list[dict]]]:
    """Link the rectangles of each cell (rows come cell by cell): of every
    component, its joint rectangle and the rows in it."""
    def finish(cell: list[dict]):
        if len(cell) == 1:
            yield cell[0], cell
            return
        high, size = np.stack([np.frombuffer(r["high"], np.uint16) for r in cell]), np.array([r["size"] for r in cell])
        component = linked(high, size, percent=percent)
        for c in np.unique(component).tolist():
            own = np.flatnonzero(component == c)
            yield cell[own[0]] | {"size": int(size[own].min()), "high": high[own].max(axis=0).tobytes()}, [cell[k] for k in own.tolist()]

    held: list[dict] = []
    for r in rows:
        if held and r["cell"] != held[0]["cell"]:
            yield from finish(held)
            held = []
        held.append(r)
    if held:
        yield from finish(held)


def few_edges(sets: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Edges between nodes that share a cell which tells little and pass the
    bound there: linked inside a task first, then rectangle by rectangle."""
    rows = sets.select("node", F.explode("few").alias("f")).select("f.cell", "f.class", "f.size", "node", "f.high")

    def page(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = {k: [] for k in ("cell", "class", "size", "node", "high", "members")}
            for rect, members in _link_cells(iter(sorted(b.to_pylist(), key=lambda r: r["cell"])), percent):
                for k in ("cell", "class", "size", "node", "high"):
                    out[k].append(rect[k])
                out["members"].append([m["node"] for m in members])
            yield pa.RecordBatch.from_arrays([pa.array(out["cell"], pa.int64()), pa.array(out["class"], pa.int32()), pa.array(out["size"], pa.int64()), pa.array(out["node"], pa.binary()),
                                              pa.array(out["high"], pa.binary()), pa.array(out["members"], pa.list_(pa.binary()))], [*out])

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found():
            for rect, members in _link_cells((r for b in batches for r in b.to_pylist()), percent):
                for m in members:
                    for x in m["members"]:
                        if x != rect["node"]:
                            yield x, rect["node"]

        a, b = [], []
        for x, y in found():
            a.append(x)
            b.append(y)
            if len(a) >= 50_000:
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary())], ["a", "b"])
                a, b = [], []
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary())], ["a", "b"])

    return (rows.mapInArrow(page, _PAGE + ", members array<binary>").repartition("cell").sortWithinPartitions("cell").mapInArrow(meet, "a binary, b binary"))


def blocking_groups(docs: DataFrame, text_col: str, sets: DataFrame, width: int, percent: int, finer: bool = False) -> DataFrame:
    """(node, component): connected cells.  ``sets`` has the sets of ``docs``
    by the same plan."""
    total = sets.agg(F.sum("telling")).first()[0] or 0
    return connected_components(telling_edges(docs, text_col, total, width, percent, finer).unionByName(few_edges(sets, percent)))


def _node_sets(rows: list[tuple[bytes, str]], width: int) -> tuple[list[int], list[np.ndarray]]:
    """Places of the rows (node, text) whose text has the node's set (a
    namesake row may not), and the sets."""
    sets: list[np.ndarray] = []
    for _, _, data, offsets in text_blocks(pa.array([t for _, t in rows], pa.string())):
        sets += shingle_sets(data, offsets, width)
    at = [k for k, ((node, _), s) in enumerate(zip(rows, sets, strict=True)) if node_of(s) == node]
    return at, [sets[k] for k in at]


def _overlap(s: np.ndarray, t: np.ndarray) -> int:
    """Size of the intersection of two sorted sets."""
    return int(np.count_nonzero(s[np.minimum(np.searchsorted(s, t), len(s) - 1)] == t))


def _vectors(sets: list[np.ndarray], size: np.ndarray) -> np.ndarray:
    groups = min(vector_groups(int(size.max())), MOST_GROUPS)
    return np.stack([count_vector(s, groups) for s in sets])


def _links_inside(rows: list[tuple[bytes, str]], width: int, percent: int) -> Iterator[tuple[bytes, bytes]]:
    """Stars that span the components of one part."""
    at, sets = _node_sets(rows, width)
    if len(at) < 2:
        return
    size = np.array([len(s) for s in sets])
    component = linked(_vectors(sets, size), size, lambda p, of: np.array([bool(links(_overlap(sets[p], sets[q]), size[p], size[q], percent)) for q in of.tolist()]), percent)
    for k, c in enumerate(component.tolist()):
        if k != c:
            yield rows[at[k]][0], rows[at[c]][0]


class _Part:
    """A part's members (node, label, text), searched by visitors."""

    def __init__(self, members: list[tuple[bytes, bytes, str]], width: int, percent: int):
        at, self.sets = _node_sets([(node, text) for node, _, text in members], width)
        self.node, self.label = [members[k][0] for k in at], [members[k][1] for k in at]
        self.width, self.percent = width, percent
        if at:
            size = np.array([len(s) for s in self.sets])
            self.tree = CountTree(_vectors(self.sets, size), size, percent)

    def links(self, visitors: list[tuple[bytes, bytes, str]]) -> Iterator[tuple[bytes, bytes]]:
        """One link of each visitor to each label that is not its own."""
        if not self.node:
            return
        groups, largest = self.tree.high.shape[1], int(self.tree.size.max())
        at, sets = _node_sets([(node, text) for node, _, text in visitors], self.width)
        for k, s in zip(at, sets, strict=True):
            if self.percent * len(s) > 100 * largest:
                continue  # larger than any partner here
            node, met = visitors[k][0], {visitors[k][1]}
            for q in self.tree.search(count_vector(s, groups).astype(np.int32), len(s)).tolist():
                if self.label[q] not in met and links(_overlap(s, self.sets[q]), len(s), len(self.sets[q]), self.percent):
                    met.add(self.label[q])
                    yield node, self.node[q]


def _edge_rows(edges: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([e[k] for e in edges], pa.binary()) for k in range(3)], ["component", "a", "b"])


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for b in batches:
        yield from zip(*(c.to_pylist() for c in b.columns), strict=True)


def links_inside(texts: DataFrame, width: int, percent: int) -> DataFrame:
    """(component, a, b): links inside each (component, part) of ``texts``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (component, _), rows in groupby(_rows(batches), key=lambda r: r[:2]):
            yield _edge_rows([(component, a, b) for a, b in _links_inside([r[2:] for r in rows], width, percent)])

    return (texts.repartition("component", "part").sortWithinPartitions("component", "part").select("component", "part", "node", "text")
            .mapInArrow(run, "component binary, a binary, b binary"))


def links_across(members: DataFrame, visitors: DataFrame, width: int, percent: int) -> DataFrame:
    """(component, a, b): links between visitors and members of a part
    (component, part, node, label, text) with other labels."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, part = None, None
        for (component, number, visit), rows in groupby(_rows(batches), key=lambda r: r[:3]):
            if not visit:
                held, part = (component, number), _Part([r[3:] for r in rows], width, percent)
                continue
            while block := [r[3:] for r in islice(rows, VISITORS)]:
                if held == (component, number):
                    yield _edge_rows([(component, a, b) for a, b in part.links(block)])

    rows = members.withColumn("visit", F.lit(False)).unionByName(visitors.withColumn("visit", F.lit(True)))
    return (rows.repartition("component", "part").sortWithinPartitions("component", "part", "visit").select("component", "part", "visit", "node", "label", "text")
            .mapInArrow(run, "component binary, a binary, b binary"))


def verified_links(docs: DataFrame, sets: DataFrame, groups: DataFrame, id_col: str, text_col: str, part_bytes: int = PART_BYTES,
                   width: int = SHINGLE, percent: int = PERCENT, part_rows: int = PART_ROWS) -> DataFrame:
    """A spanning set of the true links (a, b) inside the blocking groups
    (node, component)."""
    row = F.struct(F.col("doc_id").isNull().alias("last"), F.col("doc_id").alias("id"), F.col("key").alias("key"))
    # one row a node, pre-aggregated, before anything is joined to it
    named = (sets.groupBy("node", row.alias("at")).agg(F.count(F.lit(1)).alias("rows")).groupBy("node")
             .agg(F.min(F.struct("at", "rows")).alias("m")).join(groups, "node").select("node", "component", F.col("m.at.id").alias("at"), F.col("m.at.key").alias("at_key"), (F.col("m.rows") > 1).alias("copied")))
    named = materialise(named, "named")
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"), row_key(id_col, text_col).alias("key"))
    texts = (likely_rows(rows, "doc_id", named.select(F.col("at").alias("doc_id")))
             .join(named, F.col("doc_id").eqNullSafe(F.col("at")) & (F.col("key") == F.col("at_key"))).select("component", "node", "text", "copied"))
    candidates = materialise(texts, "candidates")
    texts = candidates.where("not copied").unionByName(candidates.where("copied").dropDuplicates(["component", "node"])).drop("copied")  # a node's text once

    def too_large(texts: DataFrame) -> DataFrame:
        """(component, extra): groups to cut, and their parts but one."""
        return materialise(texts.groupBy("component").agg(F.greatest(F.sum(F.octet_length("text")) / part_bytes, F.count(F.lit(1)) / part_rows).cast("int").alias("extra"))
                           .where("extra > 0"), "parts")

    parts = too_large(texts)
    if parts.isEmpty():
        outlive(candidates)
    else:  # what shares a passage only falls apart by finer cells
        # stored: a task that runs again must send the same batches
        large = materialise(texts.join(parts.select("component"), "component", "left_semi").select("node", "text"), "large")
        sets = materialise(document_sets(large, "node", "text", width, percent, True), "finer-sets")
        finer = blocking_groups(large, "text", sets, width, percent, True)
        texts = materialise(texts.join(parts, "component", "left_anti").select("component", "node", "text")
                            .unionByName(large.join(finer, "node").select("component", "node", "text")), "texts")
        discard(candidates, large, sets)
        parts = too_large(texts)
    part = F.pmod(F.xxhash64("node"), F.coalesce("extra", F.lit(0)) + 1).cast("int").alias("part")
    inside = materialise(links_inside(texts.join(parts, "component", "left").select("component", part, "node", "text"), width, percent), "inside")
    if parts.isEmpty():
        return inside.select("a", "b")

    cut = materialise(texts.join(parts, "component").select("component", part, "node", "text"), "cut")
    known = inside.join(parts, "component", "left_semi").select("a", "b")

    def labelled(found: DataFrame) -> DataFrame:
        """component, part, node, label of the cut groups' nodes."""
        return materialise(cut.select("component", "part", "node").join(connected_components(found).withColumnRenamed("component", "star"), "node", "left").select(
            "component", "part", "node", F.coalesce("star", "node").alias("label")), "labels")

    def guests(nodes: DataFrame) -> DataFrame:
        """The rows of ``nodes`` (component, node, label), with texts, in every part of their groups."""
        return (cut.drop("part").join(nodes, ["component", "node"]).join(parts, "component")
                .select("component", F.explode(F.sequence(F.lit(0), F.col("extra"))).alias("part"), "node", "label", "text"))

    def across(labels: DataFrame, nodes: DataFrame) -> DataFrame:
        """Links to ``nodes`` from every part.  Their copies are as many times
        as a group has parts, so they go in rounds, each to some of the parts
        and with no more bytes than the groups or ``ROUND_BYTES``."""
        members, visitors = cut.join(labels.select("node", "label"), "node").select("component", "part", "node", "label", "text"), guests(nodes)
        own = cut.agg(F.sum(F.octet_length("text"))).first()[0]
        copies = (cut.join(nodes.select("component", "node"), ["component", "node"]).groupBy("component").agg(F.sum(F.octet_length("text")).alias("size"))
                  .join(parts, "component").agg(F.sum(F.col("size") * (F.col("extra") + 1))).first()[0] or 0)
        rounds = min(-(-copies // max(own, ROUND_BYTES)) or 1, parts.agg(F.max("extra")).first()[0] + 1)
        found = []
        for k in range(rounds):
            now = F.col("part") % rounds == k
            found.append(materialise(links_across(members.where(now), visitors.where(now), width, percent), "across").select("a", "b"))
        return reduce(DataFrame.unionByName, found)

    labels = labelled(known)
    largest = Window.partitionBy("component").orderBy(F.desc("count"), "label")
    heads = (labels.groupBy("component", "label").count().withColumn("place", F.row_number().over(largest)).where(F.col("place") <= HEADS)
             .select("component", F.col("label").alias("node"), "label"))
    by_heads = across(labels, heads)
    labels = labelled(known.unionByName(by_heads))
    main = labels.groupBy("component", "label").count().groupBy("component").agg(F.max(F.struct("count", "label")).alias("m")).select("component", F.col("m.label").alias("main"))
    others = labels.join(main, "component").where("label <> main").select("component", "node", "label")
    return inside.select("a", "b").unionByName(by_heads).unionByName(across(labels, others))


def _components(docs: DataFrame, id_col: str, text_col: str, part_bytes: int, width: int, percent: int) -> DataFrame:
    """doc_id, key, n, c (a node that names the component) of every row."""
    with scratch() as keep:
        cells_too = materialise(document_sets(docs, id_col, text_col, width, percent), "cells")
        sets = keep(materialise(cells_too.select("doc_id", "key", "n", "node"), "sets"))
        blocking = blocking_groups(docs, text_col, cells_too, width, percent)
        discard(cells_too)  # only the cells' links are needed from here
        verified = keep(materialise(verified_links(docs, sets, blocking, id_col, text_col, part_bytes, width, percent), "verified"))
    found = connected_components(verified)
    return sets.select("doc_id", "key", "n", "node").join(found, "node", "left").select("doc_id", "key", "n", F.coalesce("component", "node").alias("c"))


def ngram_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_bytes: int = PART_BYTES,
                     width: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id for every row of ``docs``."""
    named = _components(docs, id_col, text_col, part_bytes, width, percent)
    names = materialise(named.where("n > 0").groupBy("c").agg(F.min("doc_id").alias("component_id")), "names")
    return named.join(names, "c", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_bytes: int = PART_BYTES,
                         width: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs``, all columns, of which each component keeps the
    one with the smallest id, and one of that one's repeated rows; documents
    without words stay."""
    with scratch() as keep:
        named = materialise(_components(docs, id_col, text_col, part_bytes, width, percent).where("n > 0"), "components")
        place = F.struct(F.col("doc_id").isNull().alias("last"), F.col("doc_id").alias("id"), F.col("key").alias("key"))
        first = materialise(named.groupBy("c").agg(F.min(place).alias("first")), "first")
        gone = keep(materialise(named.join(first, "c").where(place != F.col("first")).select("doc_id", "key").distinct(), "gone"))
        repeated = keep(materialise(named.groupBy("doc_id", "key").count().where("count > 1").select("doc_id", "key"), "repeated"))
    return keep_rows(docs, id_col, row_key(id_col, text_col), gone, repeated)


ORACLE = r"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 2], ' ') AS g FROM (SELECT doc_id, w, unnest(generate_series(1, greatest(1, len(w) - 2))) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
x AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b USING (g) WHERE a.doc_id <> b.doc_id GROUP BY 1, 2),
e AS (SELECT a, b FROM x JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * k >= 90 * (na.n + nb.n - k)),
r AS (SELECT doc_id AS a, doc_id AS b FROM d UNION SELECT r.a, e.b FROM r JOIN e ON e.a = r.b)
SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, min(r.b) AS component_id FROM d JOIN r ON r.a = d.doc_id LEFT JOIN n USING (doc_id) GROUP BY d.doc_id, n
"""
