"""SentencePiece encoding with seeded merge-dropout, and decoding.

A merge-type model joins, again and again, the neighbouring symbols whose joint piece ranks best
(leftmost among equals). With dropout a candidate (the span of its two symbols) is skipped when its keyed
hash, over seed, text key, start, split and end, falls below the rate: a candidate has one fate however
often it comes up, so the same seed and key always give the same segmentation, and others differ.

No piece of such a model holds a word break (a mark after another character), so merges never cross one
and words are independent: the agenda of all words of a batch runs in numpy, one merge per word and round.
Words of over ``LONG`` symbols run on a heap instead, in time n log n.

Text is encoded as it is: spaces are word marks, one mark is put before the text. Characters without a
piece, and a literal word-mark character, become byte pieces, so that decoding gives back every text.

Defined results: a null or empty text has no ids and decodes to the empty string; a null key is 0. Rows are
encoded one by one; repeated rows with equal keys get equal ids. An empty table gives no rows. Of extra columns
those asked for are carried, under whatever names but the ones of two underscores used here.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillframe.llm import common

MARK = "▁"
LONG = 64
_NONE = np.int32(2**31 - 1)
_TABLE_BITS = 20


class Model:
    """Pieces, merges and byte pieces of a model file."""

    def __init__(self, path: str):
        from sentencepiece import sentencepiece_model_pb2

        proto = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as file:
            proto.ParseFromString(file.read())
        kinds = proto.pieces[0].__class__
        self.pieces = [p.piece for p in proto.pieces]
        normal = {p.piece: i for i, p in enumerate(proto.pieces) if p.type in (kinds.NORMAL, kinds.USER_DEFINED)}
        self.byte_ids = np.zeros(256, dtype=np.int32)
        for i, p in enumerate(proto.pieces):
            if p.type == kinds.BYTE:
                self.byte_ids[int(p.piece[1:-1], 16)] = i
        if any(MARK in p.lstrip(MARK) for p in normal):
            raise ValueError("a piece crosses a word break")
        self.symbols = dict(normal)  # single characters without a piece of their own can still be part of one
        for p in normal:
            for c in p:
                self.symbols.setdefault(c, len(self.pieces) + len(self.symbols))
        self.of_point = np.full(0x110000, -1, dtype=np.int32)
        for s, i in self.symbols.items():
            if len(s) == 1:
                self.of_point[ord(s)] = i
        order = sorted({-proto.pieces[i].score for i in normal.values()})
        rank = {s: k for k, s in enumerate(order)}  # equal scores share a rank
        self.width = np.int64(len(self.pieces) + len(self.symbols) + 1)
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        for p, i in normal.items():
            for k in range(1, len(p)):
                left, right = self.symbols.get(p[:k]), self.symbols.get(p[k:])
                if left is not None and right is not None:
                    self.merges[left, right] = (rank[-proto.pieces[i].score], i)
        self._table()
        surface = [b"" if p.type in (kinds.UNKNOWN, kinds.CONTROL, kinds.UNUSED) else bytes([int(p.piece[1:-1], 16)]) if p.type == kinds.BYTE else p.piece.replace(MARK, " ").encode() for p in proto.pieces]
        self.surface = np.frombuffer(b"".join(surface), dtype=np.uint8)
        self.surface_end = np.cumsum([len(x) for x in surface])
        self.surface_start = self.surface_end - np.array([len(x) for x in surface])

    def _slot(self, key: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return ((key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - _TABLE_BITS)).astype(np.int64)

    def _table(self) -> None:
        """Open addressing by linear probing; a key is left symbol times width plus right symbol."""
        size = 1 << _TABLE_BITS
        self.keys = np.full(size + 64, -1, dtype=np.int64)
        self.found_rank, self.found_piece = np.zeros((2, size + 64), dtype=np.int32)
        keys = np.array([a * int(self.width) + b for a, b in self.merges], dtype=np.int64)
        for key, slot, (rank, piece) in zip(keys.tolist(), self._slot(keys).tolist(), self.merges.values()):
            while self.keys[slot] != -1:
                slot += 1
            self.keys[slot], self.found_rank[slot], self.found_piece[slot] = key, rank, piece

    def lookup(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank (_NONE: no merge) and piece of each pair."""
        key = np.where((left >= 0) & (right >= 0), left.astype(np.int64) * self.width + right, -2)
        slot = self._slot(key)
        at = self.keys[slot]
        todo = np.flatnonzero((at != key) & (at != -1))
        while len(todo):
            slot[todo] += 1
            at[todo] = self.keys[slot[todo]]
            todo = todo[(at[todo] != key[todo]) & (at[todo] != -1)]
        hit = at == key
        return np.where(hit, self.found_rank[slot], _NONE), self.found_piece[slot]


@lru_cache(maxsize=4)
def model(path: str) -> Model:
    return Model(path)


def _skipped(key: np.ndarray, start: np.ndarray, split: np.ndarray, end: np.ndarray, rate: float) -> np.ndarray:
    """Whether the keyed hash of a candidate falls below the rate."""
    with np.errstate(over="ignore"):
        h = key ^ (start.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)) ^ (((split - start).astype(np.uint64) << np.uint64(40)) + (end - start).astype(np.uint64))
    return common.mixed(h) < np.uint64(min(int(rate * 2.0**64), 2**64 - 1))


class Encoder:
    def __init__(self, path: str, rate: float = 0.0, seed: int = 0):
        self.model, self.rate, self.seed = model(path), rate, seed

    def _candidates(self, text: np.ndarray, place: np.ndarray, origin: np.ndarray, sym: np.ndarray, end: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank (or _NONE) and piece of each symbol in ``at`` with its right neighbour."""
        rank, piece = self.model.lookup(sym[at], sym[at + 1])
        if self.rate:
            some = np.flatnonzero(rank != _NONE)
            left = at[some]
            gone = _skipped(text[origin[left]], place[origin[left]], place[origin[left + 1]], place[end[left + 1] - 1] + 1, self.rate)
            rank[some[gone]] = _NONE
        return rank, piece

    def _long(self, key: int, sym: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Symbols and starts after the agenda of one long word, by a heap."""
        sym, n = sym.tolist(), len(sym)
        begin, stop = start.tolist(), end.tolist()
        before, after, alive = [*range(-1, n - 1)], [*range(1, n), -1], [True] * n
        heap: list = []
        salt = np.array([key], dtype=np.uint64)

        def push(ats: list[int]) -> None:
            ats = [i for i in ats if i >= 0 and after[i] >= 0 and (sym[i], sym[after[i]]) in self.model.merges]
            if ats and self.rate:
                column = lambda x: np.array(x, dtype=np.int64)
                gone = _skipped(np.repeat(salt, len(ats)), column([begin[i] for i in ats]), column([stop[i] for i in ats]), column([stop[after[i]] for i in ats]), self.rate)
                ats = [i for i, g in zip(ats, gone) if not g]
            for i in ats:
                rank, piece = self.model.merges[sym[i], sym[after[i]]]
                heapq.heappush(heap, (rank, begin[i], stop[i], stop[after[i]], i, piece))

        push([*range(n)])
        while heap:
            _, _, split, close, i, piece = heapq.heappop(heap)
            if not alive[i] or stop[i] != split or after[i] < 0 or stop[after[i]] != close:
                continue  # one of its symbols has merged meanwhile
            j = after[i]
            sym[i], stop[i], alive[j], after[i] = piece, close, False, after[j]
            if after[j] >= 0:
                before[after[j]] = i
            push([before[i], i])
        left = [i for i in range(n) if alive[i]]
        return np.array([sym[i] for i in left], dtype=np.int32), np.array([begin[i] for i in left], dtype=np.int64)

    def __call__(self, texts: pa.Array, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids end to end, and where each text's begin (one more for the end). keys: 64 bits for each text."""
        raw, bounds = common.text_buffer(texts)
        lead = np.zeros(len(raw) + 1, dtype=np.int64)
        np.cumsum((raw & 0xC0) != 0x80, out=lead[1:])
        points = np.frombuffer(raw.tobytes().decode().encode("utf-32-le"), dtype=np.uint32).astype(np.int64)
        cuts = lead[bounds]
        full = np.flatnonzero(np.diff(cuts))
        literal = points == ord(MARK)
        points = np.where(points == 32, ord(MARK), points)
        points, literal = np.insert(points, cuts[full], ord(MARK)), np.insert(literal, cuts[full], False)
        added = np.zeros(len(cuts), dtype=np.int64)
        added[full + 1] = 1
        cuts = cuts + np.cumsum(added)
        if not len(points):
            return np.zeros(0, np.int32), cuts
        sym = self.model.of_point[points]
        sym[literal] = -1
        mark = (points == ord(MARK)) & ~literal
        doc = np.repeat(np.arange(len(cuts) - 1), np.diff(cuts))
        key = common.mixed(common.mixed(keys.astype(np.int64).view(np.uint64)), self.seed)[doc]
        place = np.arange(len(points)) - cuts[doc]  # in the text, so that a text's ids depend on nothing else
        head = np.ones(len(points), dtype=bool)
        head[1:] = (mark[1:] & ~mark[:-1]) | (doc[1:] != doc[:-1])
        out = np.full(len(points), -2, dtype=np.int32)  # -2: inside a symbol
        heads = np.flatnonzero(head)
        size = np.diff(np.append(heads, len(points)))
        for a, n in zip(heads[size > LONG].tolist(), size[size > LONG].tolist()):
            s, begin = self._long(int(key[a]), sym[a : a + n], place[a : a + n], place[a : a + n] + 1)
            out[begin + cuts[doc[a]]] = s
        self._rounds(out, sym, key, place, np.repeat(size <= LONG, size), head)
        first = np.flatnonzero(out != -2)
        return self._with_bytes(out, first, points, doc, len(cuts) - 1)

    def _rounds(self, out: np.ndarray, sym: np.ndarray, key: np.ndarray, place: np.ndarray, chosen: np.ndarray, head: np.ndarray) -> None:
        """Runs the agendas of all chosen words together; symbols go to ``out`` at their first character."""
        origin = np.flatnonzero(chosen).astype(np.int32)
        if not len(origin):
            return
        sym, head, end = sym[origin], head[origin], origin + np.int32(1)
        inner = np.flatnonzero(~head[1:])  # with a right neighbour in their word
        rank, piece = np.full(len(origin), _NONE, dtype=np.int32), np.zeros(len(origin), dtype=np.int32)
        rank[inner], piece[inner] = self._candidates(key, place, origin, sym, end, inner)
        while True:
            heads = np.flatnonzero(head)
            best = np.minimum.reduceat(rank, heads)
            live = best != _NONE
            n_live = int(np.count_nonzero(live))
            if n_live < 0.75 * len(live):  # words that are done leave now and then
                on = np.repeat(live, np.diff(np.append(heads, len(head))))
                out[origin[~on]] = sym[~on]
                if not n_live:
                    return
                origin, sym, head, end, rank, piece = (x[on] for x in (origin, sym, head, end, rank, piece))
                heads, best, live = np.flatnonzero(head), best[live], live[live]
            size = np.diff(np.append(heads, len(head)))
            hits = np.flatnonzero((rank == np.repeat(best, size)) & (rank != _NONE))
            word = np.searchsorted(heads, hits, side="right")
            hit = hits[np.append(True, word[1:] != word[:-1])]  # the leftmost of each word
            sym[hit], end[hit] = piece[hit], end[hit + 1]
            stay = np.ones(len(sym), dtype=bool)
            stay[hit + 1] = False
            now = hit - np.arange(len(hit))  # one symbol left each earlier word
            origin, sym, head, end, rank, piece = (x[stay] for x in (origin, sym, head, end, rank, piece))
            rank[now] = _NONE
            left = now[~head[now]] - 1
            right = now[now + 1 < len(head)]
            right = right[~head[right + 1]]
            fresh = np.concatenate([left, right])
            rank[fresh], piece[fresh] = self._candidates(key, place, origin, sym, end, fresh)

    def _with_bytes(self, out: np.ndarray, first: np.ndarray, points: np.ndarray, doc: np.ndarray, n_docs: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids by text; a symbol without a piece becomes the bytes of its character."""
        ids, owner = out[first], doc[first]
        odd = np.flatnonzero((ids < 0) | (ids >= len(self.model.pieces)))
        if len(odd):
            spelled = [chr(c).encode() for c in points[first[odd]].tolist()]
            times = np.ones(len(ids), dtype=np.int64)
            times[odd] = [len(x) for x in spelled]
            begin = np.cumsum(times) - times
            ids, owner = np.repeat(ids, times), np.repeat(owner, times)
            for i, x in zip(begin[odd].tolist(), spelled):
                ids[i : i + len(x)] = self.model.byte_ids[list(x)]
        return ids.astype(np.int32), np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=n_docs))])


def decoded(m: Model, ids: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """The texts of ids end to end, without the space that was put before each."""
    begin, n = m.surface_start[ids], m.surface_end[ids] - m.surface_start[ids]
    ends = np.cumsum(n)
    total = int(ends[-1]) if len(ends) else 0
    data = m.surface[np.repeat(begin - (ends - n), n) + np.arange(total)] if total else np.zeros(0, np.uint8)
    cuts = np.concatenate([[0], ends])[bounds]
    full = np.flatnonzero(np.diff(cuts))
    data = np.delete(data, cuts[full])
    less = np.zeros(len(cuts), dtype=np.int64)
    less[full + 1] = 1
    cuts = cuts - np.cumsum(less)
    return pa.LargeStringArray.from_buffers(len(cuts) - 1, pa.py_buffer(cuts.astype(np.int64).tobytes()), pa.py_buffer(data.tobytes()))


def _encoded(path: str, rate: float, seed: int, with_ids: bool) -> callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zlib

        encode = Encoder(path, rate, seed)
        for part in common.slices(batches, "__text", 1 << 17):
            at = part.schema.get_field_index
            texts = part.column(at("__text"))
            ids, bounds = encode(texts, part.column(at("__key")).to_numpy(zero_copy_only=False))
            back = decoded(encode.model, ids, bounds)
            data = ids.astype("<u4")
            rest = [c for c in part.schema.names if c not in ("__text", "__key")]
            columns = {
                "__n_ids": pa.array(np.diff(bounds).astype(np.int64)),
                "__crc32": pa.array([zlib.crc32(data[a:b].tobytes()) for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())], pa.int64()),
                "__lossless": pc.equal(back, pc.fill_null(texts.cast(pa.large_string()), "")),
            }
            if with_ids:
                columns["__ids"] = pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(ids, pa.int32()))
            yield pa.RecordBatch.from_arrays([*(part.column(at(c)) for c in rest), *columns.values()], names=[*rest, *columns])

    return run


def encoded(docs: DataFrame, path: str, key: Column, *keep: str, rate: float = 0.1, seed: int = 0, with_ids: bool = True) -> DataFrame:
    """The columns ``keep`` with __n_ids, __crc32 (of the ids as little-endian 32 bits), __lossless and __ids.

    ``key`` (long) tells texts apart for the dropout; __lossless says that the ids decode to the text.
    """
    common.small_batches(docs)
    chosen = docs.select(*keep, F.col("text").alias("__text"), F.coalesce(key, F.lit(0)).alias("__key"))
    rest = [f"`{f.name}` {f.dataType.simpleString()}" for f in chosen.schema if f.name not in ("__text", "__key")]
    return chosen.mapInArrow(_encoded(path, rate, seed, with_ids), ", ".join([*rest, "__n_ids long, __crc32 long, __lossless boolean"] + ["__ids array<int>"] * with_ids))


def decoded_rows(rows: DataFrame, path: str, *keep: str, ids: str = "__ids") -> DataFrame:
    """The columns ``keep`` with ``text``: what the array ``ids`` decodes to."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model(path)
        for batch in batches:
            lists = pc.fill_null(batch.column(batch.num_columns - 1), [])
            bounds = np.concatenate([[0], np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False))]).astype(np.int64)
            flat = lists.flatten().to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], decoded(m, flat, bounds).cast(pa.string())], names=[*batch.schema.names[:-1], "text"])

    chosen = rows.select(*keep, F.col(ids).alias("__ids"))
    return chosen.mapInArrow(run, ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in chosen.schema if f.name != "__ids"), "text string"]))
