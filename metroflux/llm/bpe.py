"""Byte-level BPE encoding and decoding by corpus-level merge replay.

Each task collects the distinct pretokens of a block of texts, lays their
bytes end to end as linked symbols and keeps an inverted index from the
rank a neighbouring pair would merge to, to the positions where that pair
stands.  Ranks are replayed in order over all words at once: a merge is
applied at every indexed position and only the two touched neighbours are
looked up again.  A word is therefore merged once per block, however often
the corpus repeats it, and occurrences are resolved by word number.

The vocabulary is a file of (base64 token, rank) lines; ids are ranks.  Its
size is fixed, so each worker holds it once.  Memory of a task is bounded by
one block (``block_chars``, or one longer text).

Defined cases: a null text encodes as empty (no ids, empty bytes); repeated
rows are encoded alike and both returned; an empty table gives an empty
result; special-token strings are ordinary text; extra columns are carried
by ``encode`` only when asked for.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

BLOCK_CHARS = 6 << 20
_MODELS: dict = {}


class Numbers(dict):
    """Numbers keys in the order they are first asked for."""

    def __missing__(self, key):
        n = self[key] = len(self)
        return n


class Model:
    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as f:
            self.rank = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
        self.pattern = regex.compile(pattern)
        self.token = {r: t for t, r in self.rank.items()}
        self.byte = [self.rank[bytes([i])] for i in range(256)]
        self.byte_ids = np.array(self.byte, dtype=np.int32)
        pairs = [(self.rank[t[:i]] << 32 | self.rank[t[i:]], r) for t, r in self.rank.items()
                 for i in range(1, len(t)) if t[:i] in self.rank and t[i:] in self.rank]
        self.pairs = dict(pairs)
        merged = np.array(sorted(pairs), dtype=np.int64).reshape(-1, 2)
        self.keys, self.ranks = np.ascontiguousarray(merged[:, 0]), np.ascontiguousarray(merged[:, 1])

    def pair_rank(self, a: int, b: int) -> int:
        """Rank that tokens ``a b`` merge to, or -1."""
        return self.pairs.get(a << 32 | b, -1)

    def pair_ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = a.astype(np.int64) << 32 | b
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], -1)

    def replay(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of every word, by replaying the merges over all of them: all
        ids, and of each word the first id's place and the number of ids.

        One rank at a time, every place of the index that still holds it is
        merged at once.  Two kinds of words go to ``replay_word`` instead:
        those where places of one rank overlap (runs of one character), and
        those where a merge makes a pair of a lower rank, which has to come
        before the other places of the word."""
        sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        n = int(sizes.sum())
        word = np.repeat(np.arange(len(words), dtype=np.int32), sizes)
        symbol = self.byte_ids[np.frombuffer(b"".join(words), dtype=np.uint8)]
        follow, before = np.arange(1, n + 1, dtype=np.int32), np.arange(-1, n - 1, dtype=np.int32)
        last = np.cumsum(sizes)
        follow[last[sizes > 0] - 1] = -1
        before[(last - sizes)[sizes > 0]] = -1
        rank_at = np.full(n, -1, dtype=np.int32)
        inner = np.flatnonzero(follow >= 0)
        rank_at[inner] = self.pair_ranks(symbol[inner], symbol[inner + 1])
        index: dict[int, list[np.ndarray]] = {}
        queue: list[int] = []
        alone = np.zeros(len(words), dtype=bool)
        here = np.zeros(n, dtype=bool)

        def enter(places: np.ndarray) -> None:
            """Add places to the index under their pair's rank."""
            if not len(places):
                return
            order = np.argsort(rank_at[places], kind="stable")
            places = places[order]
            r = rank_at[places]
            first = [0, *(np.flatnonzero(r[1:] != r[:-1]) + 1).tolist()]
            for key, i, j in zip(r[first].tolist(), first, [*first[1:], len(r)], strict=True):
                if key in index:
                    index[key].append(places[i:j])
                else:
                    index[key] = [places[i:j]]
                    heapq.heappush(queue, key)

        enter(inner[rank_at[inner] >= 0])
        while queue:
            rank = heapq.heappop(queue)
            found = index.pop(rank)
            places = np.unique(np.concatenate(found)) if len(found) > 1 else found[0]
            places = places[(rank_at[places] == rank) & ~alone[word[places]]]
            right = follow[places]
            here[places] = True
            overlap = here[right]
            here[places] = False
            if overlap.any():
                alone[word[places[overlap]]] = True
                places = places[~alone[word[places]]]
                right = follow[places]
            if not len(places):
                continue
            after = follow[right]
            symbol[places] = rank
            symbol[right] = -1
            rank_at[right] = -1
            follow[places] = after
            linked = after >= 0
            before[after[linked]] = places[linked]
            left = before[places]
            here[places] = True
            touched = np.concatenate([places, left[(left >= 0) & ~here[left]]])
            here[places] = False
            rank_at[places] = -1
            ahead = touched[follow[touched] >= 0]
            rank_at[ahead] = self.pair_ranks(symbol[ahead], symbol[follow[ahead]])
            made = rank_at[ahead]
            if (low := (made >= 0) & (made < rank)).any():
                alone[word[ahead[low]]] = True
            enter(ahead[made >= 0])
        kept = np.flatnonzero(symbol >= 0)
        flat = symbol[kept].astype(np.uint32)
        first = np.searchsorted(kept, last - sizes)
        lengths = np.searchsorted(kept, last) - first
        if alone.any():
            own = np.flatnonzero(alone)
            ids = [self.replay_word(words[w]) for w in own.tolist()]
            lengths[own] = [len(x) for x in ids]
            first[own] = len(flat) + np.cumsum(lengths[own]) - lengths[own]
            flat = np.concatenate([flat, *ids])
        return flat, first, lengths

    def replay_word(self, word: bytes) -> np.ndarray:
        """The same replay inside one word, place by place."""
        n, pair_rank = len(word), self.pair_rank
        symbol = [self.byte[c] for c in word]
        follow, before = [*range(1, n), -1], list(range(-1, n - 1))
        queue = [(r, i) for i in range(n - 1) if (r := pair_rank(symbol[i], symbol[i + 1])) >= 0]
        heapq.heapify(queue)
        while queue:
            rank, i = heapq.heappop(queue)
            j = follow[i]
            if symbol[i] < 0 or j < 0 or pair_rank(symbol[i], symbol[j]) != rank:
                continue  # a neighbour was taken meanwhile
            symbol[i], symbol[j], k, h = rank, -1, follow[j], before[i]
            follow[i] = k
            if k >= 0:
                before[k] = i
                if (r := pair_rank(rank, symbol[k])) >= 0:
                    heapq.heappush(queue, (r, i))
            if h >= 0 and (r := pair_rank(symbol[h], rank)) >= 0:
                heapq.heappush(queue, (r, h))
        return np.array([x for x in symbol if x >= 0], dtype=np.uint32)

    def encode(self, texts: list[str]) -> Iterator[np.ndarray]:
        """Token ids of each text (uint32)."""
        number, findall = Numbers(), self.pattern.findall
        docs = [np.fromiter(map(number.__getitem__, found), dtype=np.int32, count=len(found)) for found in map(findall, texts)]
        flat, first, lengths = self.replay([w.encode() for w in number])
        for d in docs:
            n = lengths[d]
            ends = np.cumsum(n)
            total = int(ends[-1]) if len(d) else 0
            yield flat[np.repeat(first[d] - ends + n, n) + np.arange(total)]

    def decode(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.token.__getitem__, ids.tolist()))


def model(path: str, pattern: str) -> Model:
    """One vocabulary per worker process."""
    if (path, pattern) not in _MODELS:
        _MODELS.clear()
        _MODELS[path, pattern] = Model(path, pattern)
    return _MODELS[path, pattern]


def text_runs(texts: list[str], limit: int) -> Iterator[tuple[int, int]]:
    i = size = 0
    for j, t in enumerate(texts):
        if j > i and size + len(t) > limit:
            yield i, j
            i, size = j, 0
        size += len(t)
    if i < len(texts):
        yield i, len(texts)


def encode(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text",
           block_chars: int = BLOCK_CHARS) -> DataFrame:
    """(doc_id, ids array<long>) of every row of ``docs``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = model(path, pattern)
        for b in batches:
            texts = [t or "" for t in b.column(1).to_pylist()]
            for i, j in text_runs(texts, block_chars):
                ids = list(bpe.encode(texts[i:j]))
                offsets = np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int32)
                flat = pa.array(np.concatenate(ids).astype(np.int64))
                yield pa.RecordBatch.from_arrays([b.column(0).slice(i, j - i), pa.ListArray.from_arrays(offsets, flat)], ["doc_id", "ids"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(docs[id_col], docs[text_col].cast("string")).mapInArrow(run, f"doc_id {kind}, ids array<long>")


def decode(encoded: DataFrame, path: str, pattern: str) -> DataFrame:
    """(doc_id, ids) back to (doc_id, text binary)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = model(path, pattern)
        for b in batches:
            out = [bpe.decode(np.array(x or [], dtype=np.int64)) for x in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.binary())], ["doc_id", "text"])

    kind = encoded.schema["doc_id"].dataType.simpleString()
    return encoded.select("doc_id", "ids").mapInArrow(run, f"doc_id {kind}, text binary")


def round_trip(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text",
               block_chars: int = BLOCK_CHARS) -> DataFrame:
    """Encode and decode in one pass: doc_id, n_tokens, ids_sha256 (ids as
    little-endian unsigned 32-bit integers), decoded_sha256."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = model(path, pattern)
        for b in batches:
            texts = [t or "" for t in b.column(1).to_pylist()]
            for i, j in text_runs(texts, block_chars):
                rows = [(len(ids), hashlib.sha256(ids.astype("<u4").tobytes()).hexdigest(), hashlib.sha256(bpe.decode(ids)).hexdigest())
                        for ids in bpe.encode(texts[i:j])]
                n, ids_sha, text_sha = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays([b.column(0).slice(i, j - i), pa.array(n, pa.int64()), pa.array(ids_sha), pa.array(text_sha)],
                                                 ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(docs[id_col], docs[text_col].cast("string")).mapInArrow(
        run, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
