"""Near-duplicate join on word shingles: banded MinHash candidates, Bayesian pruning, exact verification.

A text's shingles are its runs of five words (all its words, if fewer). Texts with equal shingle sets
become one representative first, so copies cost nothing later. Representatives that share a band of their
signature are compared value by value: after each chunk of signature positions, a pair is dropped once the
posterior probability that its similarity reaches the threshold (uniform prior, so a binomial tail) falls
below ``TOLERANCE``. What remains gives, per bucket, the edges of a spanning forest, and their connected
components the groups in which pairs are then verified: there all pairs of a group pass the same pruning
and the survivors' shingle sets are intersected exactly. Verified links are counted per representative
and, again as spanning forests, give the classes.

Buckets and groups of any size are cut into blocks; each pair of blocks is a task of its own. A block has about
``BLOCK`` rows, more where that would make over ``BLOCKS`` of them, since each row is copied once per block, and
at most ``MOST_ROWS`` rows or ``MOST_BYTES`` of shingles. No pairs are written: a task compares ``BLOCK`` by
``BLOCK`` rows at a time and gives counts and at most one edge per row. While candidates are looked for, a task
ends once its rows are connected. Bands of ``ROWS`` values miss a pair of similarity 0.8 with probability 5e-5
(less above), and the comparison within groups finds most of those.

Defined results: a text without words (null, empty, white space) has no shingles, no links and a class of
its own. class_id is the least doc_id of the class; a null doc_id is never the least while there is
another. Repeated rows are copies of each other. An empty table has no classes. Other columns are carried,
whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillframe.llm import common, components

WORDS = 5
THRESHOLD = 0.8
BANDS, ROWS = 25, 5
VALUES = BANDS * ROWS
CHUNK = 25
TOLERANCE = 1e-6
BLOCK = 256
BLOCKS = 64
MOST_ROWS = 16384
MOST_BYTES = 32 << 20
_FACTORS = (common.mixed(np.arange(VALUES), 11) | np.uint64(1)).astype(np.uint64)
_ROLL = np.uint64(0x9E3779B97F4A7C15)


def least_matches(seen: int, threshold: float = THRESHOLD) -> int:
    """The fewest equal values of ``seen`` at which a similarity of ``threshold`` is still likely enough.

    With a uniform prior the posterior of at least t, after m of n, is P(Binomial(n + 1, t) <= m).
    """
    total = 0.0
    for m in range(seen + 1):
        total += comb(seen + 1, m) * threshold**m * (1 - threshold) ** (seen + 1 - m)
        if total >= TOLERANCE:
            return m
    return seen


_LEAST = {n: least_matches(n) for n in range(CHUNK, VALUES + 1, CHUNK)}


def shingles(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of all texts end to end, and where each text's begin."""
    raw, bounds = common.text_buffer(texts)
    n_docs = len(bounds) - 1
    solid = ~common.WHITE[raw]
    first, last = solid.copy(), solid.copy()
    if len(raw):
        first[1:] &= ~solid[:-1]
        last[:-1] &= ~solid[1:]
        inner = bounds[(bounds > 0) & (bounds < len(raw))]
        first[inner], last[inner - 1] = solid[inner], solid[inner - 1]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    doc = np.searchsorted(bounds, start, side="right") - 1
    code = _word_codes(raw, start, end)
    words = np.bincount(doc, minlength=n_docs)
    ends = np.cumsum(words)
    room = ends[doc] - np.arange(len(doc))
    h = np.zeros(len(code), dtype=np.uint64)
    with np.errstate(over="ignore"):
        for k in range(WORDS):
            inside = np.flatnonzero(room > k)
            h[inside] = (h[inside] + code[inside + k]) * _ROLL
            h[inside] ^= h[inside] >> np.uint64(29)
    whole = (room >= WORDS) | ((words[doc] < WORDS) & (room == words[doc]))
    h, doc = common.mixed(h[whole], 3), doc[whole]
    order = np.lexsort((h, doc))
    h, doc = h[order], doc[order]
    new = np.ones(len(h), dtype=bool)
    new[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
    h, doc = h[new], doc[new]
    return h, np.concatenate([[0], np.cumsum(np.bincount(doc, minlength=n_docs))])


def _word_codes(raw: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64 bits for each word, by its bytes alone."""
    from xxhash import xxh3_64_intdigest

    coded = common.strings(raw, start, end).dictionary_encode()
    values = np.fromiter(map(xxh3_64_intdigest, coded.dictionary.to_pylist()), dtype=np.uint64, count=len(coded.dictionary))
    return values[coded.indices.to_numpy(zero_copy_only=False)] if len(start) else np.zeros(0, np.uint64)


def signatures(h: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """MinHash values (32 bits) of each non-empty set, a row each."""
    full = bounds[:-1][np.diff(bounds) > 0]
    out = np.zeros((len(full), VALUES), dtype=np.uint32)
    with np.errstate(over="ignore"):
        for k in range(VALUES if len(full) else 0):
            out[:, k] = np.minimum.reduceat((h * _FACTORS[k]) >> np.uint64(32), full)
    return out


def _fingerprints(h: np.ndarray, starts: np.ndarray) -> list[bytes]:
    """128 bits of each set."""
    if not len(starts):
        return []
    sums = np.stack([np.add.reduceat(common.mixed(h, s), starts) for s in (21, 22)], axis=1)
    return [x.tobytes() for x in sums.astype(">u8")]


def _profiled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Fingerprint, signature (16 bits a value) and band keys of each text that has words."""
    for part in common.slices(batches, "__text", 1 << 20):
        at = part.schema.get_field_index("__text")
        h, bounds = shingles(part.column(at))
        full = np.flatnonzero(np.diff(bounds))
        sig = signatures(h, bounds)
        bands = np.zeros((len(full), BANDS), dtype=np.uint64)
        with np.errstate(over="ignore"):
            for r in range(ROWS):
                bands = common.mixed(bands * _ROLL + sig[:, r::ROWS].astype(np.uint64), 5)
            bands ^= common.mixed(np.arange(BANDS), 9)
        prints = _fingerprints(h, bounds[full])
        spread = lambda values, kind: pa.array([values.get(i) for i in range(part.num_rows)], kind)
        where = dict(zip(full.tolist(), range(len(full))))
        columns = [c for i, c in enumerate(part.columns) if i != at]
        names = [c for c in part.schema.names if c != "__text"]
        low = (sig & 0xFFFF).astype("<u2")
        yield pa.RecordBatch.from_arrays(
            [
                *columns,
                spread({i: prints[k] for i, k in where.items()}, pa.binary()),
                pa.array(np.diff(bounds)),
                spread({i: low[k].tobytes() for i, k in where.items()}, pa.binary()),
                spread({i: bands[k].astype(np.int64).tolist() for i, k in where.items()}, pa.list_(pa.int64())),
            ],
            names=[*names, "f", "n_shingles", "sig", "bands"],
        )


class Forest:
    """Union by least index."""

    def __init__(self, n: int):
        self.parent = list(range(n))
        self.trees = n

    def root(self, x: int) -> int:
        while self.parent[x] != x:
            self.parent[x] = self.parent[self.parent[x]]
            x = self.parent[x]
        return x

    def join(self, a: int, b: int) -> bool:
        a, b = self.root(a), self.root(b)
        if a == b:
            return False
        self.parent[max(a, b)] = min(a, b)
        self.trees -= 1
        return True


def likely(left: np.ndarray, right: np.ndarray, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows of two signature blocks that no chunk of values made too unlikely."""
    if same:
        i, j = np.triu_indices(len(left), 1)
    else:
        i, j = (x.reshape(-1) for x in np.indices((len(left), len(right))))
    equal = np.zeros(len(i), dtype=np.int64)
    for n in range(0, VALUES, CHUNK):
        if not len(i):
            break
        equal += (left[i, n : n + CHUNK] == right[j, n : n + CHUNK]).sum(axis=1)
        stay = equal >= _LEAST[n + CHUNK]
        i, j, equal = i[stay], j[stay], equal[stay]
    return i, j


def _grouped(batches: Iterator[pa.RecordBatch], keys: tuple[str, ...]) -> Iterator[list[dict]]:
    """Runs of equal keys in sorted rows."""
    run, key = [], None
    for batch in batches:
        for row in batch.to_pylist():
            it = tuple(row[k] for k in keys)
            if it != key and run:
                yield run
                run = []
            key = it
            run.append(row)
    if run:
        yield run


def _sides(run: list[dict]) -> tuple[list[dict], list[dict], bool]:
    """Rows of the task's two blocks, each representative once; whether both are the same block."""
    rows = {(r["own"], r["f"]): r for r in run}
    left = [r for (own, _), r in rows.items() if own == run[0]["i"]]
    if run[0]["i"] == run[0]["j"]:
        return left, left, True
    return left, [r for (own, _), r in rows.items() if own != run[0]["i"]], False


_TASK = ("key", "i", "j")


def _matrix(rows: list[dict]) -> np.ndarray:
    return np.frombuffer(b"".join(r["sig"] for r in rows), dtype="<u2").reshape(len(rows), VALUES)


def _likely_pairs(left: np.ndarray, right: np.ndarray, same: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """:func:`likely` of two sides of any size, a square of BLOCK by BLOCK rows at a time."""
    for a in range(0, len(left), BLOCK):
        for b in range(a if same else 0, len(right), BLOCK):
            i, j = likely(left[a : a + BLOCK], right[b : b + BLOCK], same and a == b)
            if len(i):
                yield i + a, j + b


def _edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A spanning forest of the likely pairs of each task."""
    for run in _grouped(batches, _TASK):
        left, right, same = _sides(run)
        if not left or not right:
            continue
        names = [r["f"] for r in left] + ([] if same else [r["f"] for r in right])
        forest, out = Forest(len(names)), []
        for i, j in _likely_pairs(_matrix(left), _matrix(right), same):
            for a, b in zip(i.tolist(), (j if same else j + len(left)).tolist()):
                if forest.join(a, b):
                    out.append((names[a], names[b]))
            if forest.trees == 1:
                break
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(list(x), pa.binary()) for x in zip(*out)], names=["a", "b"])


def intersections(left: list[np.ndarray], right: list[np.ndarray], width: int = 8192) -> np.ndarray:
    """Sizes of all intersections of two lists of sorted sets, by products of incidence columns."""
    out = np.zeros((len(left), len(right)), dtype=np.int64)
    shared = np.intersect1d(np.concatenate(left), np.concatenate(right))
    columns = lambda sets, some: np.stack([np.isin(some, x, assume_unique=True) for x in sets]).astype(np.float32)
    for at in range(0, len(shared), width):
        some = shared[at : at + width]
        out += (columns(left, some) @ columns(right, some).T).astype(np.int64)
    return out


def _verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per representative of a task: linked documents; and a spanning forest of the links as (f, other)."""
    for run in _grouped(batches, _TASK):
        left, right, same = _sides(run)
        if not left or not right:
            continue
        weight = lambda side: np.array([r["n_copies"] for r in side], dtype=np.int64)
        names = [r["f"] for r in left] + ([] if same else [r["f"] for r in right])
        links, w_left, w_right = np.zeros(len(names), dtype=np.int64), weight(left), weight(right)
        forest, out = Forest(len(names)), []
        for i, j in _likely_pairs(_matrix(left), _matrix(right), same):
            rows, columns = np.unique(i), np.unique(j)
            sets = lambda side, some: [np.frombuffer(side[k]["shingles"], dtype="<u8") for k in some.tolist()]
            a, b = sets(left, rows), sets(right, columns)
            common_n = intersections(a, b)[np.searchsorted(rows, i), np.searchsorted(columns, j)]
            size = lambda x: np.array([len(s) for s in x])
            union = size(a)[np.searchsorted(rows, i)] + size(b)[np.searchsorted(columns, j)] - common_n
            linked = 10 * common_n >= round(10 * THRESHOLD) * union
            i, j = i[linked], j[linked]
            other = j if same else j + len(left)
            np.add.at(links, i, w_right[j])
            np.add.at(links, other, w_left[i])
            if forest.trees > 1:
                for x, y in zip(i.tolist(), other.tolist()):
                    if forest.join(x, y):
                        out.append((names[x], names[y], None))
        out += [(names[k], None, int(links[k])) for k in np.flatnonzero(links).tolist()]
        if not out:
            continue
        yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], t) for k, t in enumerate((pa.binary(), pa.binary(), pa.int64()))], names=["f", "other", "links"])


def _tasks(rows: DataFrame, size: Column, held: Column | None = None) -> DataFrame:
    """Rows with ``key`` dealt to the pairs of blocks of their key; ``size`` counts the rows of a key, ``held`` their bytes."""
    blocks = F.greatest(F.least(F.ceil(size / BLOCK), F.lit(BLOCKS)), F.ceil(size / MOST_ROWS), F.ceil((F.lit(0) if held is None else held) / MOST_BYTES)).cast("int")
    own = F.pmod(F.xxhash64("f"), blocks).cast("int")
    dealt = rows.withColumn("own", own).withColumn("other_block", F.explode(F.sequence(F.lit(0), blocks - 1)))
    paired = dealt.withColumn("i", F.least("own", "other_block")).withColumn("j", F.greatest("own", "other_block")).drop("other_block", "size", "held")
    n = common.partitions_for(rows.sparkSession)
    return paired.repartition(n, *_TASK).sortWithinPartitions(*_TASK)


IDENTITY = ["d", "no_id", "t"]


def _identity(docs: DataFrame) -> list[Column]:
    """Columns that tell rows apart but for repeated ones: doc_id, whether it is null, and a hash of the text."""
    return [F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("d"), F.col("doc_id").isNull().alias("no_id"), F.xxhash64(common.text_or_empty()).alias("t")]


def _representatives(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """A row per row of ``docs`` with its fingerprint; and a row per fingerprint: copies, least identity, signature, bands."""
    rows = common.checkpointed(docs.select(*_identity(docs), F.col("text").alias("__text")).mapInArrow(_profiled, "d long, no_id boolean, t long, f binary, n_shingles long, sig binary, bands array<long>"))
    least = F.min(F.struct("no_id", "d", "t"))
    one = rows.where("f IS NOT NULL").groupBy("f").agg(F.count("*").alias("n_copies"), least.alias("least"), F.first("n_shingles").alias("n_shingles"), F.first("sig").alias("sig"), F.first("bands").alias("bands"))
    return rows, common.checkpointed(one.select("f", "n_copies", "n_shingles", F.col("least.no_id").alias("no_id"), F.col("least.d").alias("d"), F.col("least.t").alias("t"), "sig", "bands"))


def _groups(one: DataFrame, n: int) -> DataFrame:
    """f and key: the groups that pairs sharing a band, and not pruned, connect."""
    keyed = one.select("f", F.explode("bands").alias("key"))
    full = keyed.groupBy("key").agg(F.count("*").alias("size")).where("size > 1")
    members = common.joined_to_hot(keyed, full, "key", "size", BANDS * n).join(one.select("f", "sig"), "f")
    near = components.labelled(_tasks(members, F.col("size")).mapInArrow(_edges, "a binary, b binary"))
    return common.checkpointed(near.select(F.col("node").alias("f"), F.col("label").alias("key")).join(one.select("f", "n_copies", "n_shingles", *IDENTITY, "sig"), "f"))


def _links(docs: DataFrame, grouped: DataFrame, n: int) -> DataFrame:
    """Verified links inside groups: (f, other) of a spanning forest, and (f, links)."""
    size = grouped.groupBy("key").agg(F.count("*").alias("size"), (F.lit(8) * F.sum("n_shingles")).alias("held"))
    texts = docs.select(*_identity(docs), F.col("text").alias("__text"))
    wanted = texts.join(common.joined_to_hot(grouped, size, "key", "size", n), IDENTITY).select("key", "size", "held", "f", "n_copies", "sig", "__text")
    sets = wanted.mapInArrow(_with_sets, "key binary, size long, held long, f binary, n_copies long, sig binary, shingles binary")
    found = common.checkpointed(_tasks(sets, F.col("size"), F.col("held")).mapInArrow(_verified, "f binary, other binary, links long"))
    del wanted, sets
    common.freed(docs.sparkSession)
    return found


def classes(docs: DataFrame) -> DataFrame:
    """A row per row of ``docs``: d, no_id, t (its identity), label, class_id, copy_id and n_links.

    copy_id is the least doc_id with the same shingles; n_links counts the other documents linked, copies
    included; label is null for a text without words.
    """
    common.small_batches(docs)
    rows, one = _representatives(docs)
    n_rows, n_one = rows.count(), one.count()
    found = _links(docs, _groups(one, n_one), n_one)
    label = components.labelled(found.where("other IS NOT NULL").select(F.col("f").alias("a"), F.col("other").alias("b"))).withColumnsRenamed({"node": "f"})
    links = found.where("links IS NOT NULL").groupBy("f").agg(F.sum("links").alias("links"))
    own = F.when(~F.col("no_id"), F.col("d"))
    each = one.select("f", "n_copies", own.alias("copy_id")).join(label, "f", "left").join(links, "f", "left")
    each = common.checkpointed(each.select("f", F.coalesce("label", "f").alias("label"), "n_copies", "copy_id", (F.coalesce("links", F.lit(0)) + F.col("n_copies") - 1).alias("n_links")))
    class_of = each.groupBy("label").agg(F.min("copy_id").alias("class_id"), F.count("*").alias("n_texts"))
    by_print = common.checkpointed(common.joined_to_hot(each, class_of, "label", "n_texts", n_one))
    out = common.joined_to_hot(rows.select(*IDENTITY, "f"), by_print, "f", "n_copies", n_rows, "left")
    alone = F.col("f").isNull()
    return out.select(*IDENTITY, "label", *(F.when(alone, own).otherwise(F.col(c)).alias(c) for c in ("class_id", "copy_id")), F.coalesce("n_links", F.lit(0)).alias("n_links"))


def _with_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in common.slices(batches, "__text", 1 << 20):
        at = part.schema.get_field_index("__text")
        h, bounds = shingles(part.column(at))
        packed = [h[a:b].astype("<u8").tobytes() for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())]
        rest = [c for c in part.schema.names if c != "__text"]
        yield pa.RecordBatch.from_arrays([*(part.column(c) for c in rest), pa.array(packed, pa.binary())], names=[*rest, "shingles"])


def one_of_each(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each class, that of the least doc_id; texts without words all stay."""
    found = common.checkpointed(classes(docs))
    chosen = found.where("label IS NOT NULL").groupBy("label").agg(F.min(F.struct("no_id", "d", "t")).alias("c")).select("c.*")
    named = {f"__{c}": x for c, x in zip(IDENTITY, _identity(docs))}
    marked = docs.select("*", *(x.alias(c) for c, x in named.items()), common.text_or_empty().rlike(r"[^\x20\x09-\x0D]").alias("__worded"))
    kept = marked.where("__worded").join(chosen.select(*(F.col(c).alias(f"__{c}") for c in IDENTITY)), [*named], "left_semi").dropDuplicates([*named])
    return kept.unionByName(marked.where("NOT __worded")).select(*(F.col(f"`{c}`") for c in docs.columns))
