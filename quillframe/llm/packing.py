"""Best-fit packing by exact complements.

Documents become token ids, cut only where longer than a sequence. How pieces are combined depends on
their lengths alone, so the plan is made from the histogram of lengths: at most ``CAPACITY`` rows, whatever
the corpus. For each length, longest first, the gap it leaves is looked up among the single lengths, the
sums of two and the sums of three that are still available; a combination that fills the gap exactly is
consumed as often as the counts allow. What finds no exact complement is filled best-fit, longest piece
first. Every step uses up a length, so the plan has a bounded number of rows, and it is the only thing
sent to executors. A piece finds its place from its rank among the pieces of its length: its rank in its
partition plus the counts of earlier partitions; no length's pieces meet in one task.

Words between white space are independent for the tokenizer, so every distinct word of a batch is encoded
once; a test holds the ids against whole-text encoding.

Defined results: a null or empty text is the single closing id. Repeated rows and repeated or null doc_id
are packed row by row. Columns to carry are named by the caller. An empty table gives no rows.
"""

from __future__ import annotations

import os
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quillframe.llm import common

CAPACITY = 4096
CLOSING_ID = 1
#: Distinct words that a worker remembers before it starts anew.
REMEMBERED = 500_000
#: Words that one call encodes.
AT_ONCE = 1024


_TAIL = np.zeros(256, dtype=bool)
_TAIL[[ord(c) for c in ".,;:!?#*$%&"]] = True
_LETTER = np.zeros(256, dtype=bool)
_LETTER[[*range(65, 91), *range(97, 123)]] = True


def _without_tails(raw: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words with a trailing run of marks after a letter made a word of its own, as the pre-tokenizer does."""
    if not len(start):
        return start, end
    place = np.where(_TAIL[raw], np.int32(-1), np.arange(len(raw), dtype=np.int32))
    body = np.maximum.accumulate(place)[end - 1] + 1  # end of the word without its marks
    latin = np.zeros(len(start), dtype=bool)  # two bytes of a letter with an accent
    two = np.flatnonzero(body - 2 >= start)
    latin[two] = (raw[body[two] - 2] == 0xC3) & (raw[body[two] - 1] != 0x97) & (raw[body[two] - 1] != 0xB7)
    cut = (body > start) & (body < end)
    cut[cut] &= _LETTER[raw[body[cut] - 1]] | latin[cut]
    return np.sort(np.concatenate([start, body[cut]])), np.sort(np.concatenate([body[cut], end]))


def _lowered(raw: np.ndarray) -> np.ndarray:
    """ASCII letters in lower case (the tokenizer does so too), except where a combining mark may follow or a special token may be."""
    after = np.append(raw[1:], 0)
    upper = (raw >= 65) & (raw <= 90) & ((after < 0x80) | (after == 0xC3))
    if b"<|" in raw.tobytes():
        return raw
    return np.where(upper, raw + np.uint8(32), raw)


class WordEncoder:
    """Token ids of texts by a tokenizer whose pre-tokens never cross ASCII white space."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self._forget()

    def _forget(self) -> None:
        self.words = pa.array([], pa.large_string())
        self.ids = np.zeros(1 << 20, dtype=np.uint32)
        self.starts = np.zeros(1 << 16, dtype=np.int64)
        self.ends = np.zeros(1 << 16, dtype=np.int64)
        self.used = 0

    def _learn(self, words: pa.LargeStringArray) -> None:
        """Encodes words, many in one call, which tells each token's word."""
        each = words.to_pylist()
        groups = [each[k : k + AT_ONCE] for k in range(0, len(each), AT_ONCE)]
        found = self.tokenizer.encode_batch(groups, is_pretokenized=True, add_special_tokens=False)
        size = np.concatenate([np.bincount(np.array(x.word_ids, dtype=np.int64), minlength=len(g)) for g, x in zip(groups, found)])
        ends = self.used + np.cumsum(size)
        first, last = len(self.words), len(self.words) + len(words)
        used = int(ends[-1])
        while used > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        while last > len(self.starts):
            self.starts, self.ends = (np.concatenate([x, np.zeros_like(x)]) for x in (self.starts, self.ends))
        self.ids[self.used : used] = np.concatenate([np.array(x.ids, dtype=np.uint32) for x in found])
        self.starts[first:last], self.ends[first:last] = ends - size, ends
        self.words = pa.concat_arrays([self.words, words])
        self.used = used

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids end to end, and where each text's begin (one more for the end)."""
        raw, bounds = common.text_buffer(texts)
        solid = ~common.WHITE[raw]
        first, last = solid.copy(), solid.copy()
        if len(raw):
            first[1:] &= ~solid[:-1]
            last[:-1] &= ~solid[1:]
            inner = bounds[(bounds > 0) & (bounds < len(raw))]
            first[inner], last[inner - 1] = solid[inner], solid[inner - 1]
        start, end = _without_tails(raw, np.flatnonzero(first), np.flatnonzero(last) + 1)
        raw = _lowered(raw)
        coded = common.strings(raw, start, end).dictionary_encode()
        if len(self.words) > REMEMBERED:
            self._forget()
        place = pc.index_in(coded.dictionary, value_set=self.words)
        number = pc.fill_null(place, -1).to_numpy(zero_copy_only=False).astype(np.int64)
        fresh = np.flatnonzero(number < 0)
        if len(fresh):
            number[fresh] = len(self.words) + np.arange(len(fresh))
            self._learn(coded.dictionary.take(pa.array(fresh)))
        each = number[coded.indices.to_numpy(zero_copy_only=False)] if len(number) else np.zeros(0, np.int64)
        size = self.ends[each] - self.starts[each]
        ends = np.cumsum(size)
        take = np.repeat(self.starts[each] - (ends - size), size) + np.arange(ends[-1] if len(ends) else 0)
        before = np.concatenate([[0], ends])
        return self.ids[take], before[np.searchsorted(start, bounds)]


@lru_cache(maxsize=2)
def encoder(path: str) -> WordEncoder:
    """One for all tasks of a worker."""
    return WordEncoder(path)


def cut(ids: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Piece number and ids of a document's pieces."""
    for k in range(0, len(ids), CAPACITY):
        yield k // CAPACITY, ids[k : k + CAPACITY]


def _pieces(path: str, with_ids: bool) -> callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encode, part = encoder(path), TaskContext.get().partitionId()
        seen = np.zeros(CAPACITY + 1, dtype=np.int64)
        for batch in common.slices(batches, "__text", 1 << 20):
            ids, bounds = encode(batch.column(batch.schema.get_field_index("__text")))
            rows, out = [], {"__piece": [], "__start": [], "__length": [], "__crc32": [], "__nth": [], "__ids": []}
            for row in range(batch.num_rows):
                closed = np.append(ids[bounds[row] : bounds[row + 1]], np.uint32(CLOSING_ID)).astype("<u4")
                for k, piece in cut(closed):
                    data = piece.tobytes()
                    rows.append(row)
                    out["__piece"].append(k)
                    out["__start"].append(k * CAPACITY)
                    out["__length"].append(len(piece))
                    out["__crc32"].append(zlib.crc32(data))
                    out["__nth"].append(seen[len(piece)])
                    out["__ids"].append(data if with_ids else None)
                    seen[len(piece)] += 1
            kept = batch.select([c for c in batch.schema.names if c != "__text"]).take(pa.array(rows, pa.int64()))
            columns = {
                "__piece": pa.array(out["__piece"], pa.int32()),
                **{c: pa.array(out[c], pa.int64()) for c in ("__start", "__length", "__crc32", "__nth")},
                "__part": pa.array([part] * len(rows), pa.int64()),
            }
            if with_ids:
                columns["__ids"] = pa.array(out["__ids"], pa.binary())
            yield pa.RecordBatch.from_arrays([*kept.columns, *columns.values()], names=[*kept.schema.names, *columns])

    return run


def pieces(docs: DataFrame, path: str, *keep: str, with_ids: bool = False) -> DataFrame:
    """A row per piece: the columns ``keep``, __piece, __start, __length, __crc32, __nth, __part (and __ids)."""
    common.small_batches(docs)
    chosen = docs.select(*keep, F.col("text").alias("__text"))
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in chosen.schema if f.name != "__text"), "__piece int, __start long, __length long, __crc32 long, __nth long, __part long"] + ["__ids binary"] * with_ids)
    return chosen.mapInArrow(_pieces(path, with_ids), schema)


def _complement(gap: int, have: np.ndarray) -> tuple[int, ...] | None:
    """One, two or three available lengths that sum to ``gap``, long ones first."""
    if have[gap]:
        return (gap,)
    there = have[: gap + 1] > 0
    two = np.flatnonzero(there & there[::-1])  # a and gap - a
    for a in two[two * 2 >= gap][::-1].tolist():
        if a * 2 != gap or have[a] > 1:
            return (a, gap - a)
    lengths = np.flatnonzero(there)
    for a in lengths[lengths * 3 >= gap][::-1].tolist():
        rest = gap - a
        if rest < 2:
            continue
        some = there[: rest + 1]
        pair = np.flatnonzero(some & some[::-1])
        for b in pair[(pair * 2 >= rest) & (pair <= a)][::-1].tolist():
            need = Counter((a, b, rest - b))
            if all(have[x] >= k for x, k in need.items()):
                return (a, b, rest - b)
    return None


def plan(counts: dict[int, int]) -> list[tuple[int, int, tuple[tuple[int, int], ...]]]:
    """(first sequence, number of sequences, lengths with their numbers) for pieces counted by length."""
    have = np.zeros(CAPACITY + 1, dtype=np.int64)
    for length, n in counts.items():
        have[length] = n
    out: list = []
    total = 0

    def use(lengths: Counter, times: int) -> None:
        nonlocal total
        for x, k in lengths.items():
            have[x] -= k * times
        out.append((total, times, tuple(sorted(lengths.items(), reverse=True))))
        total += times

    for length in range(CAPACITY, 0, -1):
        while have[length]:
            have[length] -= 1  # the one whose gap is filled
            gap = CAPACITY - length
            found = _complement(gap, have) if gap else ()
            have[length] += 1
            if found is not None:
                lengths = Counter((length, *found))
                use(lengths, int(min(have[x] // k for x, k in lengths.items())))
                continue
            lengths, spare = Counter((length,)), have.copy()
            spare[length] -= 1
            while gap:  # best fit: the longest piece that still goes in
                fits = np.flatnonzero(spare[: gap + 1])
                if not len(fits):
                    break
                best = int(fits[-1])
                k = int(min(gap // best, spare[best]))
                lengths[best] += k
                spare[best] -= k
                gap -= k * best
            use(lengths, int(min(have[x] // k for x, k in lengths.items())))
    return out


def _slots(counts: dict[int, int]) -> dict[int, tuple[np.ndarray, ...]]:
    """By length, in order of rank: first rank, number in a sequence, first sequence, offset of the first one."""
    rows, rank = defaultdict(list), Counter()
    for first, times, lengths in plan(counts):
        offset = 0
        for length, k in lengths:
            rows[length].append((rank[length], k, first, offset))
            rank[length] += k * times
            offset += k * length
    return {x: tuple(np.array(c, dtype=np.int64) for c in zip(*r)) for x, r in rows.items()}


def _placed(slots: dict[int, tuple[np.ndarray, ...]]) -> callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index
            length = batch.column(at("__length")).to_numpy(zero_copy_only=False)
            rank = batch.column(at("__rank")).to_numpy(zero_copy_only=False)
            sequence, offset = np.zeros((2, len(length)), dtype=np.int64)
            for x in np.unique(length).tolist():
                rows = np.flatnonzero(length == x)
                first, k, base, begin = slots[x]
                slot = np.searchsorted(first, rank[rows], side="right") - 1
                inside = rank[rows] - first[slot]
                sequence[rows] = base[slot] + inside // k[slot]
                offset[rows] = begin[slot] + inside % k[slot] * x
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(sequence), pa.array(offset)], names=[*batch.schema.names, "__sequence", "__offset"])

    return run


def packed(docs: DataFrame, path: str, *keep: str) -> DataFrame:
    """A row per piece: the columns ``keep``, __piece, __start, __length, __crc32, __sequence and __offset."""
    made = common.checkpointed(pieces(docs, path, *keep))
    by_part = made.groupBy("__length", "__part").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("__length").orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    before = by_part.select("__length", "__part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("__before"))
    counts = {r["__length"]: r["n"] for r in by_part.groupBy("__length").agg(F.sum("n").alias("n")).collect()}  # CAPACITY rows at most
    ranked = made.join(before, ["__length", "__part"]).withColumn("__rank", F.col("__before") + F.col("__nth"))
    chosen = ranked.select(*keep, "__piece", "__start", "__length", "__crc32", "__rank")
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in chosen.schema), "__sequence long, __offset long"])
    return chosen.mapInArrow(_placed(_slots(counts)), schema).drop("__rank")


def sequences(docs: DataFrame, path: str) -> DataFrame:
    """The packed token ids: sequence_id, n_tokens and ids (little-endian unsigned 32-bit) of each sequence."""
    named = docs.select("doc_id", "text").withColumn("__row", common.row_key("doc_id", "text"))
    placed = packed(named, path, "__row").select("__row", "__piece", "__sequence", "__offset", "__length", F.row_number().over(Window.partitionBy("__row", "__piece").orderBy("__sequence", "__offset")).alias("__copy"))
    made = pieces(named, path, "__row", with_ids=True).select("__row", "__piece", "__ids", F.row_number().over(Window.partitionBy("__row", "__piece").orderBy("__part", "__nth")).alias("__copy"))
    whole = placed.join(made, ["__row", "__piece", "__copy"]).groupBy("__sequence")
    rows = whole.agg(F.sum("__length").alias("n_tokens"), F.sort_array(F.collect_list(F.struct("__offset", "__ids"))).alias("rows"))
    joined = F.aggregate("rows", F.lit(b""), lambda a, r: F.concat(a, r["__ids"]))
    return rows.select(F.col("__sequence").alias("sequence_id"), "n_tokens", joined.alias("ids"))
