"""Packing documents into fixed-length training sequences by the sum-of-squares rule.

An item goes where the sum, over residual gaps, of the squared number of open sequences with that gap becomes
smallest: into an open sequence of some gap, or into a new one. Spread-out gaps are what lets later items close
sequences exactly. The state is one counter per gap, whatever the number of items.

Pieces are dealt to shards by a hash; each shard is packed in one task, long pieces first. Sequences left
open by the shards are then items of the next round, so the waste does not grow with the number of shards.
"""

from __future__ import annotations

import zlib
from functools import lru_cache
from itertools import chain
from unicodedata import is_normalized

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelkit.llm.common import on_workers, ragged, written

SHARD = 50_000          # items of one task, on average


class WordIds:
    """Ids of texts by a tokenizer file whose merges never cross a space or line break.

    A batch of texts is cut into chunks by Arrow, which also numbers the distinct ones; only those are looked up, and
    only new ones encoded (at most about ``cached`` are kept). The file's own normaliser lower-cases, so A-Z may be
    lower-cased before. A full stop or comma behind a letter (one that lower-casing leaves as it is) begins a piece of its
    own, so a space may stand between them. A text that holds one of the file's special strings is encoded whole by the library.
    """

    def __init__(self, path: str, cached: int = 800_000):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.plain = Tokenizer.from_file(path)
        self.plain.encode_special_tokens = True         # a chunk of a text without special strings holds none
        self.model = self.plain.model
        self.byte_chars = _byte_chars()
        self.cached = cached
        self.clear()

    def clear(self) -> None:
        self.known = pa.array([], pa.string())          # the chunks, by their numbers
        self.ids, self.first, self.count = np.zeros(0, np.uint32), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def _chunk_ids(self, chunk: str) -> list[int]:
        # letters alone are one piece for the merges; within these alphabets lower-casing goes letter by letter
        if chunk.isalpha() and (chunk.isascii() or (max(chunk) < "\u0250" and is_normalized("NFC", chunk))):
            low = chunk.lower()
            if low.isascii():
                return [t.id for t in self.model.tokenize(low)]
            if low.isalpha():
                return [t.id for t in self.model.tokenize(low.encode().decode("latin-1").translate(self.byte_chars))]
        return self.plain.encode(chunk, add_special_tokens=False).ids

    def _numbers(self, chunks: pa.Array) -> np.ndarray:
        """The number of each of some distinct chunks; new ones are encoded."""
        if len(self.known) > self.cached:
            self.clear()
        found = pc.index_in(chunks, value_set=self.known)
        new = chunks.filter(pc.is_null(found))
        if len(new):
            ids = [self._chunk_ids(c) for c in new.to_pylist()]
            count = np.fromiter(map(len, ids), np.int64, len(ids))
            self.first = np.concatenate([self.first, len(self.ids) + np.cumsum(count) - count])
            self.count = np.concatenate([self.count, count])
            self.ids = np.concatenate([self.ids, np.fromiter(chain.from_iterable(ids), np.uint32, int(count.sum()))])
            self.known = pa.concat_arrays([self.known, new])
        numbers = pc.fill_null(found, -1).to_numpy(zero_copy_only=False).astype(np.int64)
        numbers[numbers < 0] = np.arange(len(self.known) - len(new), len(self.known))
        return numbers

    def encode(self, texts: pa.Array, end: list[int] = []) -> tuple[np.ndarray, np.ndarray]:
        """The ids of some texts (null: empty), one after the other, each followed by ``end``; and their numbers."""
        texts = pc.fill_null(texts, "")
        apart = pc.match_substring(texts, self.special[0]) if self.special else pa.array(np.zeros(len(texts), bool))
        for s in self.special[1:]:
            apart = pc.or_(apart, pc.match_substring(texts, s))
        whole = np.flatnonzero(apart.to_numpy(zero_copy_only=False))
        own = [self.tokenizer.encode(texts[int(i)].as_py(), add_special_tokens=False).ids for i in whole]
        if len(whole):
            texts = pc.if_else(apart, "", texts)
        spaced = pc.replace_substring(pc.ascii_lower(texts), "\n", " ")
        spaced = pc.replace_substring_regex(spaced, r"([\p{Ll}\p{Lo}\p{Lm}])([.,])", r"\1 \2")
        lists = pc.split_pattern(spaced, " ")
        names = lists.flatten().dictionary_encode()
        at = self._numbers(names.dictionary)[names.indices.to_numpy(zero_copy_only=False)]
        count = self.count[at]
        upto = np.concatenate([[0], np.cumsum(count)])
        edges = upto[np.cumsum(np.concatenate([[0], pc.list_value_length(lists).to_numpy(zero_copy_only=False)]))]
        ids, sizes = ragged(self.ids, self.first[at], count), np.diff(edges)
        places = edges[1:]
        if len(whole):
            ids = np.insert(ids, np.repeat(places[whole], [len(x) for x in own]), [t for x in own for t in x]).astype(np.uint32)
            sizes[whole] += [len(x) for x in own]
            places = np.cumsum(sizes)
        if end:
            ids = np.insert(ids, np.repeat(places, len(end)), np.tile(np.array(end, np.uint32), len(places)))
            sizes = sizes + len(end)
        return ids, sizes


def _byte_chars() -> dict[int, str]:
    """The characters that stand for bytes in a byte-level vocabulary: printable ones for themselves, others from 256 on."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + k) for k, b in enumerate(hidden)}


@lru_cache(2)
def _word_ids(path: str) -> WordIds:
    import os
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return WordIds(path)


def _slices(batch: pa.RecordBatch, limit: int = 4 << 20):
    """Parts of a batch of about ``limit`` bytes of text (a longer text is a part of its own)."""
    sizes = pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy(zero_copy_only=False)
    part = np.cumsum(sizes) // limit
    lo = 0
    for hi in [*(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]:
        if hi > lo:
            yield batch.slice(lo, hi - lo)
        lo = hi


def token_pieces(docs: DataFrame, tokenizer_path: str, capacity: int = 4096, end_id: int = 1,
                 with_ids: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``piece``, ``start``, ``length``, ``ids_crc32`` (and ``ids``): a document's ids and the end
    id, cut into pieces of ``capacity`` only where longer. A null text has only the end id. Null and repeated
    doc_ids, and rows that repeat, give their own pieces; other columns are ignored."""
    def run(batches):
        words = _word_ids(tokenizer_path)
        for batch in batches:
            for part in _slices(batch):
                ids, sizes = words.encode(part.column(1), [end_id])
                pieces = -(-sizes // capacity)
                at = np.repeat(np.arange(len(sizes)), pieces)
                piece = np.arange(len(at)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
                start = piece * capacity
                length = np.minimum(sizes[at] - start, capacity)
                begin = (np.cumsum(sizes) - sizes)[at] + start
                data = memoryview(ids.astype("<u4", copy=False)).cast("B")
                crc = [zlib.crc32(data[a:b]) for a, b in zip((4 * begin).tolist(), (4 * (begin + length)).tolist())]
                arrays = [part.column(0).take(pa.array(at)), pa.array(piece.astype(np.int32)), pa.array(start),
                          pa.array(length), pa.array(crc, pa.int64())]
                names = ["doc_id", "piece", "start", "length", "ids_crc32"]
                if with_ids:
                    edges = np.concatenate([begin, [len(ids)]]).astype(np.int32)
                    arrays.append(pa.ListArray.from_arrays(pa.array(edges), pa.array(ids.astype(np.int32))))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(arrays, names)

    narrow = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = narrow.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint"
    return on_workers(narrow).mapInArrow(run, schema + (", ids array<int>" if with_ids else ""))


def sum_of_squares(lengths: np.ndarray, capacity: int) -> np.ndarray:
    """The sequence number of each item, placed in the given order.

    With N(g) open sequences of gap g, putting an item of length s into gap g changes the sum of squares by
    2 (N(g - s) - N(g) + 1), or by 1 - 2 N(g) if it closes the sequence; a new sequence changes it by
    2 N(capacity - s) + 1. Ties go to the smallest gap, a new sequence last.
    """
    n = np.zeros(capacity + 1, np.int64)
    open_at: list[list[int]] = [[] for _ in range(capacity + 1)]
    out = np.empty(len(lengths), np.int64)
    used = 0
    for i, s in enumerate(lengths.tolist()):
        gaps = n[s:capacity]                                        # gap s .. capacity - 1
        change = np.where(gaps > 0, 2 * (n[:capacity - s] - gaps + 1), np.iinfo(np.int64).max)
        if s < capacity and gaps[0] > 0:
            change[0] = 1 - 2 * gaps[0]
        fresh = 2 * n[capacity - s] + 1 if s < capacity else 0
        g = int(change.argmin()) + s if s < capacity else capacity
        if g < capacity and change[g - s] <= fresh:
            k = open_at[g].pop()
            n[g] -= 1
        else:
            k, g = used, capacity
            used += 1
        out[i] = k
        if g > s:
            n[g - s] += 1
            open_at[g - s].append(k)
    return out


def _packed_shard(pdf: pd.DataFrame, capacity: int) -> pd.DataFrame:
    """Bins of one shard, items longest first (ties by key, so a retry packs alike)."""
    pdf = pdf.sort_values(["length", "item"], ascending=[False, True], kind="stable")
    lengths = pdf["length"].to_numpy(np.int64)
    bins = sum_of_squares(lengths, capacity)
    order = np.argsort(bins, kind="stable")
    before = np.cumsum(lengths[order]) - lengths[order]
    own = bins[order]
    first = np.concatenate([[True], own[1:] != own[:-1]])
    offset = np.empty(len(bins), np.int64)
    offset[order] = before - np.maximum.accumulate(np.where(first, before, 0))
    return pd.DataFrame({"item": pdf["item"].to_numpy(), "length": lengths, "shard": pdf["shard"].to_numpy(),
                         "bin": bins, "offset": offset})


def _pack_round(items: DataFrame, capacity: int, name: str) -> DataFrame:
    """``item``, ``length`` -> ``item``, ``length``, ``bin``, ``offset``; bins of the shards get apart numbers."""
    shards = max(1, -(-items.count() // SHARD))
    dealt = items.withColumn("shard", F.pmod(F.xxhash64("item"), F.lit(shards)))
    dealt = dealt.repartition(shards, "shard")                  # few bytes, much work: tasks by number, not by size
    packed = on_workers(dealt).groupBy("shard").applyInPandas(
        lambda pdf: _packed_shard(pdf, capacity), "item bigint, length bigint, shard bigint, bin bigint, offset bigint")
    return written(packed.select("item", "length", (F.col("shard") * F.lit(1 << 32) + F.col("bin")).alias("bin"),
                                 "offset"), name)


def pack(pieces: DataFrame, capacity: int = 4096, rounds: int = 2) -> DataFrame:
    """``pieces`` (any columns, with ``length`` from 1 to ``capacity``) with ``sequence_id`` and ``offset``.

    Every piece is placed, gapless from 0 in its sequence, none over ``capacity``. Pieces with equal columns
    are apart pieces. Null lengths are not allowed; an empty table stays empty. Existing columns named
    ``sequence_id`` or ``offset`` are replaced.
    """
    pieces = written(pieces.drop("sequence_id", "offset"), "pieces")        # numbered once, then read back
    pieces = written(pieces.withColumn("__item", F.monotonically_increasing_id()), "numbered")
    placed = _pack_round(pieces.select(F.col("__item").alias("item"), F.col("length").cast("long")), capacity, "bins")
    for _ in range(rounds - 1):
        bins = written(placed.groupBy("bin").agg(F.sum("length").alias("length")), "fill").where(
            F.col("length") < capacity)
        joined = _pack_round(bins.select(F.col("bin").alias("item"), "length"), capacity, "rebins")
        moved = joined.select(F.col("item").alias("bin"), F.col("offset").alias("_shift"),
                              (-1 - F.col("bin")).alias("_to"))
        placed = written(placed.join(moved, "bin", "left").select(
            "item", "length", F.coalesce("_to", "bin").alias("bin"),
            (F.col("offset") + F.coalesce("_shift", F.lit(0))).alias("offset")), "placed")
    places = placed.select(F.col("item").alias("__item"), F.col("bin").alias("sequence_id"), "offset")
    return pieces.join(places, "__item").drop("__item")
