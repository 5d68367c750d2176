"""Byte-level BPE encoding and decoding.

Pre-tokenisation is vectorised: every code point becomes a symbol class through one array lookup, a small
automaton's transition functions are composed by an associative scan (functions of blocks are composed first,
then every block is run from its entry state), and token boundaries are read off the states. No regular
expression runs over a text. The slices between boundaries feed a cache of merged pieces; the byte offsets of
the ids are kept, so any span of ids can be decoded and traced to its text.

The automaton accepts the pattern
``'s|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+``.
"""

from __future__ import annotations

import base64
import hashlib
import sys
from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelkit.llm.common import on_workers, ragged

# symbols: letters that occur in contractions apart from the others
LETTER, S_LIKE, R, V, LL, E_, NUMBER, OTHER, APOSTROPHE, SPACE, WHITE, RESET = range(12)
# states: what the text so far ends in
(FRESH, IN_WORD, IN_NUMBER, IN_OTHER, AFTER_SPACE, QUOTE, QUOTE_R, QUOTE_V, QUOTE_L, SUFFIX_END) = range(10)
_BLOCK = 64          # characters whose functions are composed one after the other
_SLAB = 1 << 19      # characters scanned at a time (bounds the memory of a very long text)


def _transitions() -> np.ndarray:
    t = np.zeros((12, 10), np.uint8)
    for sym in (LETTER, S_LIKE, R, V, LL, E_):
        t[sym] = IN_WORD
    for sym, state in ((S_LIKE, SUFFIX_END), (R, QUOTE_R), (V, QUOTE_V), (LL, QUOTE_L)):
        t[sym, QUOTE] = state                       # 's 't 'm 'd end at once; 're 've 'll need a second letter
    t[E_, [QUOTE_R, QUOTE_V]] = SUFFIX_END
    t[LL, QUOTE_L] = SUFFIX_END
    t[NUMBER], t[OTHER], t[SPACE], t[WHITE], t[RESET] = IN_NUMBER, IN_OTHER, AFTER_SPACE, FRESH, FRESH
    t[APOSTROPHE] = QUOTE                           # an apostrophe that begins a token may begin a suffix
    t[APOSTROPHE, [AFTER_SPACE, IN_OTHER, QUOTE]] = IN_OTHER
    return t


_T = _transitions()
_TF = _T.ravel()


@lru_cache(1)
def symbol_table() -> np.ndarray:
    """Symbol of every code point."""
    import regex
    table = np.full(0x110000, OTHER, np.uint8)
    points = np.arange(0x110000, dtype=np.uint32)
    chars = points[(points < 0xD800) | (points > 0xDFFF)]
    everything = chars.tobytes().decode("utf-32-le")
    for pattern, sym in ((r"\p{L}+", LETTER), (r"\p{N}+", NUMBER), (r"\s+", WHITE)):
        for m in regex.finditer(pattern, everything):   # over the alphabet, once per process
            table[chars[m.start():m.end()]] = sym
    table[0x1C:0x20] = OTHER                            # not white space by Unicode's property
    for letters, sym in (("stmd", S_LIKE), ("r", R), ("v", V), ("l", LL), ("e", E_), ("'", APOSTROPHE), (" ", SPACE)):
        table[[ord(x) for x in letters]] = sym
    return table


def scan_states(symbols: np.ndarray, state: int = FRESH) -> np.ndarray:
    """The automaton's state after each symbol, by composing transition functions block-wise."""
    n = len(symbols)
    if n <= _BLOCK:
        out = np.empty(n, np.uint8)
        for i, sym in enumerate(symbols.tolist()):
            out[i] = state = int(_T[sym, state])
        return out
    rows = -(-n // _BLOCK)
    grid = np.full(rows * _BLOCK, RESET, np.uint8)
    grid[:n] = symbols
    grid = np.ascontiguousarray(grid.reshape(rows, _BLOCK).T).astype(np.int16) * 10
    whole = np.tile(np.arange(10, dtype=np.uint8), (rows, 1))    # the identity
    for column in grid:
        whole = _TF[column[:, None] + whole]
    entry = _entries(whole, state)
    out = np.empty((_BLOCK, rows), np.uint8)
    for k, column in enumerate(grid):
        out[k] = entry = _TF[column + entry]
    return out.T.reshape(-1)[:n]


def _entries(functions: np.ndarray, state: int) -> np.ndarray:
    """State before each function: an exclusive scan under composition (doubling)."""
    prefix, step = functions, 1
    while step < len(prefix):
        later = prefix.copy()
        later[step:] = np.take_along_axis(prefix[step:], prefix[:-step], axis=1)
        prefix, step = later, 2 * step
    return np.concatenate([[np.uint8(state)], prefix[:-1, state]])


def _starts(symbols: np.ndarray) -> np.ndarray:
    """Where tokens start; RESET symbols (between texts) are no part of any token."""
    n = len(symbols)
    states, state = np.empty(n, np.uint8), FRESH
    for lo in range(0, n, _SLAB):
        states[lo:lo + _SLAB] = scan_states(symbols[lo:lo + _SLAB], state)
        state = int(states[min(lo + _SLAB, n) - 1])
    before_state = np.concatenate([[np.uint8(FRESH)], states[:-1]])
    before = np.concatenate([[np.uint8(RESET)], symbols[:-1]])
    after = np.concatenate([symbols[1:], [np.uint8(RESET)]])
    white = (symbols == SPACE) | (symbols == WHITE)
    white_before = (before == SPACE) | (before == WHITE)
    ends = after == RESET
    solid_next = ~ends & (after != SPACE) & (after != WHITE)
    start = (before == RESET)
    start |= white & (~white_before | solid_next)       # a run of white space gives its last character away
    letter, letter_before = symbols <= E_, before <= E_
    number, number_before = symbols == NUMBER, before == NUMBER
    other, other_before = (symbols == OTHER) | (symbols == APOSTROPHE), (before == OTHER) | (before == APOSTROPHE)
    start |= (before == WHITE) & ~white
    start |= letter & (number_before | other_before) | number & (letter_before | other_before)
    start |= other & (letter_before | number_before)
    start |= letter & (before_state == SUFFIX_END)      # the word goes on after a suffix: a new token
    # letters of a suffix belong to the apostrophe's token
    after_state = np.concatenate([states[1:], [np.uint8(FRESH)]])
    second_follows = (after_state == SUFFIX_END) & ~ends
    single = (states == SUFFIX_END) & (before_state == QUOTE)
    pending = (states >= QUOTE_R) & (states <= QUOTE_L) & second_follows
    start &= ~(single | pending)
    start &= symbols != RESET
    return np.flatnonzero(start)


class Ranks:
    """Merge ranks with a cache of merged pieces; ids of the cached pieces lie in one flat array."""

    def __init__(self, ranks: dict[bytes, int], cached: int = 600_000):
        self.ranks, self.cached = ranks, cached
        self.tokens = [b""] * (max(ranks.values()) + 1)
        for token, i in ranks.items():
            self.tokens[i] = token
        self.sizes = np.array([len(x) for x in self.tokens], np.int64)
        self.flat = np.frombuffer(b"".join(self.tokens), np.uint8)
        self.at = np.cumsum(self.sizes) - self.sizes
        self.clear()

    @classmethod
    def read(cls, path: str) -> "Ranks":
        """A rank file: lines of a base64 token and its rank."""
        with open(path, "rb") as f:
            return cls({base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())})

    def clear(self) -> None:
        self.index: dict[bytes, int] = {}
        self.ids, self.first, self.count = array("I"), array("q"), array("q")

    def merge(self, piece: bytes) -> list[int]:
        """Ids of one piece: the pair of lowest rank is merged until none is left."""
        ranks = self.ranks
        if piece in ranks:
            return [ranks[piece]]
        if len(piece) > 200:
            return self._merge_long(piece)
        parts = [piece[i:i + 1] for i in range(len(piece))]
        get, none = ranks.get, sys.maxsize
        pairs = [get(a + b, none) for a, b in zip(parts, parts[1:])]
        while pairs and (best := min(pairs)) != none:
            i = pairs.index(best)
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
            del pairs[i]
            if i < len(pairs):
                pairs[i] = get(parts[i] + parts[i + 1], none)
            if i:
                pairs[i - 1] = get(parts[i - 1] + parts[i], none)
        return [ranks[x] for x in parts]

    def _merge_long(self, piece: bytes) -> list[int]:
        """The same with a heap over linked parts: long pieces take n log n steps."""
        import heapq
        n, ranks = len(piece), self.ranks
        end, prev, alive = list(range(1, n + 1)), list(range(-1, n - 1)), [True] * n
        heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(piece[i:i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, stop = heapq.heappop(heap)
            j = end[i] if alive[i] else n
            if j >= n or end[j] != stop or not alive[j]:
                continue
            alive[j], end[i] = False, stop
            if stop < n:
                prev[stop] = i
                if (r := ranks.get(piece[i:end[stop]])) is not None:
                    heapq.heappush(heap, (r, i, end[stop]))
            h = prev[i]
            if h >= 0 and (r := ranks.get(piece[h:stop])) is not None:
                heapq.heappush(heap, (r, h, stop))
        return [ranks[piece[i:end[i]]] for i in range(n) if alive[i]]

    def lookup(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the pieces one after the other, and the number of ids of each piece."""
        if len(self.index) > self.cached:
            self.clear()
        index = self.index
        for piece in [x for x in set(pieces) if x not in index]:
            ids = self.merge(piece)
            index[piece] = len(self.first)
            self.first.append(len(self.ids))
            self.count.append(len(ids))
            self.ids.extend(ids)
        at = np.fromiter(map(index.__getitem__, pieces), np.int64, len(pieces))
        flat = np.frombuffer(self.ids, np.uint32) if self.ids else np.zeros(0, np.uint32)
        first, count = (np.frombuffer(x, np.int64) if x else np.zeros(0, np.int64) for x in (self.first, self.count))
        return ragged(flat, first[at], count[at]), count[at]

    def encode(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
        """(ids, byte offset of each id in the text's UTF-8) of each text."""
        out: list[tuple[np.ndarray, np.ndarray]] = []
        group, size = [], 0
        for text in texts:
            group.append(text)
            size += len(text) + 1
            if size >= _SLAB:
                out += self._encode(group)
                group, size = [], 0
        return out + (self._encode(group) if group else [])

    def _encode(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
        lengths = np.array([len(x) for x in texts], np.int64)
        joined = "\n".join(texts) + "\n"
        points = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
        symbols = symbol_table()[points]
        breaks = np.cumsum(lengths + 1) - 1
        symbols[breaks] = RESET
        starts = _starts(symbols)
        raw = joined.encode()
        byte_at = np.zeros(len(points) + 1, np.int64)
        np.cumsum(1 + (points > 0x7F) + (points > 0x7FF) + (points > 0xFFFF), out=byte_at[1:])
        break_of = np.searchsorted(breaks, starts)
        stops = np.minimum(np.append(starts[1:], len(points)), breaks[break_of]) if len(starts) else starts
        lo, hi = byte_at[starts], byte_at[stops]
        ids, count = self.lookup([raw[a:b] for a, b in zip(lo.tolist(), hi.tolist())])
        sizes = self.sizes[ids]
        offset = np.cumsum(sizes) - sizes                   # tokens cover the texts without gaps
        per_text = np.bincount(break_of, weights=count, minlength=len(texts)).astype(np.int64)
        edge = np.concatenate([[0], np.cumsum(per_text)])
        return [(ids[a:b], offset[a:b] - (offset[a] if b > a else 0)) for a, b in zip(edge[:-1], edge[1:])]

    def decode(self, ids: np.ndarray) -> bytes:
        ids = np.asarray(ids, np.int64)
        return ragged(self.flat, self.at[ids], self.sizes[ids]).tobytes()


@lru_cache(4)
def _ranks(path: str) -> Ranks:
    return Ranks.read(path)


def _local(path: str) -> str:
    """A rank file is installed on every machine, or was sent to the executors with ``addFile``."""
    import os
    return path if os.path.exists(path) else SparkFiles.get(os.path.basename(path))


def _encoded(batches, ranks_path: str):
    """Batches of (doc_id, text) -> (doc_id, ids, offsets)."""
    ranks = _ranks(_local(ranks_path))
    for batch in batches:
        for lo in range(0, batch.num_rows, 512):
            part = batch.slice(lo, 512)
            done = ranks.encode([x or "" for x in part.column(1).to_pylist()])
            edges = np.concatenate([[0], np.cumsum([len(ids) for ids, _ in done])]).astype(np.int32)
            ids = np.concatenate([x for x, _ in done]).astype(np.int32)
            offsets = np.concatenate([x for _, x in done]).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.ListArray.from_arrays(edges, pa.array(ids)),
                 pa.ListArray.from_arrays(edges, pa.array(offsets))], ["doc_id", "ids", "offsets"])


def _decoded(batches, ranks_path: str):
    """Batches of (doc_id, ids, ...) -> (doc_id, ids, decoded)."""
    ranks = _ranks(_local(ranks_path))
    for batch in batches:
        ids = batch.column(1)
        texts = [ranks.decode(x.values.to_numpy(zero_copy_only=False)) if x.is_valid else b"" for x in ids]
        yield pa.RecordBatch.from_arrays([batch.column(0), ids, pa.array(texts, pa.binary())],
                                         ["doc_id", "ids", "decoded"])


def encode_documents(docs: DataFrame, ranks_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``ids`` (array of int), ``offsets`` (byte offset of each id in the text).

    ``ranks_path`` is a file of merge ranks that every executor can open. A null text is empty and has no
    ids; null and repeated doc_ids, and rows that repeat, give one row each. Other columns are ignored.
    """
    narrow = _narrow(docs, id_col, text_col)
    kind = narrow.schema["doc_id"].dataType.simpleString()
    return narrow.mapInArrow(lambda b: _encoded(b, ranks_path), f"doc_id {kind}, ids array<int>, offsets array<bigint>")


def decode_documents(encoded: DataFrame, ranks_path: str) -> DataFrame:
    """``doc_id``, ``ids``, ``decoded`` (binary) of rows with ``doc_id`` and ``ids``; null ids give no bytes."""
    narrow = on_workers(encoded.select("doc_id", "ids"))
    kind = narrow.schema["doc_id"].dataType.simpleString()
    return narrow.mapInArrow(lambda b: _decoded(b, ranks_path), f"doc_id {kind}, ids array<int>, decoded binary")


def _narrow(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return on_workers(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")))


def ids_digest(ids) -> str:
    """sha256 of ids as little-endian unsigned 32-bit integers."""
    return hashlib.sha256(np.asarray(ids, "<u4").tobytes()).hexdigest()


def round_trip_digests(docs: DataFrame, ranks_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode, decode, and digest both in one pass (one Python worker per task): ``doc_id``, ``n_tokens``,
    ``ids_sha256``, ``decoded_sha256``. Nulls and repeats as in :func:`encode_documents`."""
    def run(batches):
        for batch in _decoded(_encoded(batches, ranks_path), ranks_path):
            ids = batch.column(1)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(x) for x in ids], pa.int64()),
                 pa.array([ids_digest(x.values.to_numpy(zero_copy_only=False)) for x in ids]),
                 pa.array([hashlib.sha256(x.as_py()).hexdigest() for x in batch.column(2)])],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    narrow = _narrow(docs, id_col, text_col)
    kind = narrow.schema["doc_id"].dataType.simpleString()
    return narrow.mapInArrow(run, f"doc_id {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string")
