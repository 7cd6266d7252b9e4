"""Line deduplication by a range-partitioned, sorted stream of line hashes.

Each line of at least ``LEAST_POINTS`` code points becomes (128-bit hash of its key, document, text hash,
position). These rows are dealt by range over hash, document (largest first) and position, so a line that
a third of all documents share is spread over many partitions; every partition is sorted and streamed
once. Lines of a key that ``LEAST_DOCS`` documents hold stay only in the first document of the stream.
A run that crosses partitions is settled from one summary row per partition (first and last run), which
is all that the driver sees. Results are keep bitmaps per document, packed and deflated; texts do not
pass through the sort.

Defined results: a null or empty text is one empty line and keeps it. Rows with an equal doc_id count as
one document; rows with equal doc_id and text share a bitmap; a null doc_id is a document of its own,
below all others. Other columns are carried, whatever their names.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillframe.llm import common

LEAST_POINTS = 20
LEAST_DOCS = 3
_STRIPPED = " \t\n\x0b\x0c\r"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_COLUMNS = ("h1", "h2", "doc", "no_id", "row", "pos")
_DROPPED = "doc long, no_id boolean, row long, pos int"


def _row() -> Column:
    return F.xxhash64(common.text_or_empty())


def keyed_lines(docs: DataFrame) -> DataFrame:
    """A row for each line whose key is long enough: hash, document, text hash and position."""
    key = F.translate(F.trim(F.col("line"), F.lit(_STRIPPED)), _UPPER, _LOWER)
    return (
        docs.select("doc_id", _row().alias("row"), F.posexplode(F.split(common.text_or_empty(), "\n")).alias("pos", "line"))
        .select("doc_id", "row", "pos", key.alias("key"))
        .where(F.length("key") >= LEAST_POINTS)
        .select(
            F.xxhash64("key").alias("h1"),
            F.xxhash64(F.lit(1), "key").alias("h2"),
            F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("doc"),
            F.col("doc_id").isNull().alias("no_id"),
            "row",
            "pos",
        )
    )


def _arrays(batch: pa.RecordBatch) -> dict[str, np.ndarray]:
    return {c: batch.column(i).to_numpy(zero_copy_only=False) for i, c in enumerate(_COLUMNS)}


def _changes(rows: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Where a new key begins, and where a new document or key begins."""
    key, doc = np.ones((2, len(rows["h1"])), dtype=bool)
    key[1:] = (rows["h1"][1:] != rows["h1"][:-1]) | (rows["h2"][1:] != rows["h2"][:-1])
    doc[1:] = key[1:] | (rows["doc"][1:] != rows["doc"][:-1]) | (rows["no_id"][1:] != rows["no_id"][:-1])
    return key, doc


def _ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row: the partition's first and last run as key, first document, last document and count."""
    from pyspark import TaskContext

    first = current = None
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = _arrays(batch)
        key, doc = _changes(rows)
        starts = np.flatnonzero(key)
        spans = [(0, int(starts[1]) if len(starts) > 1 else len(key))]
        if len(starts) > 1:
            spans.append((int(starts[-1]), len(key)))
        for a, b in spans:
            it = (int(rows["h1"][a]), int(rows["h2"][a]))
            head, tail = ((bool(rows["no_id"][i]), int(rows["doc"][i])) for i in (a, b - 1))
            n = int(doc[a:b].sum())
            if current is not None and current[0] == it:
                current = (it, current[1], tail, current[3] + n - (current[2] == head))
            else:
                if current is not None and first is None:
                    first = current
                current = (it, head, tail, n)
    if current is not None:
        first = first or current
        flat = [[TaskContext.get().partitionId()], *([x] for run in (first, current) for x in (*run[0], *run[1], *run[2], run[3]))]
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in flat], names=_ENDS_NAMES)


_RUN = ("h1", "h2", "head_no_id", "head", "tail_no_id", "tail", "n")
_ENDS_NAMES = ["part", *(f"{at}_{x}" for at in ("first", "last") for x in _RUN)]
_ENDS = ", ".join(f"{x} {'boolean' if x.endswith('no_id') else 'long'}" for x in _ENDS_NAMES)


def _settled(ends: list) -> dict[tuple[int, int], tuple[tuple[bool, int], bool]]:
    """For keys at the partitions' edges: the document that keeps its lines, and whether others lose theirs."""
    runs: dict = {}
    for row in sorted(ends, key=lambda r: r["part"]):
        seen = []
        for at in ("first", "last"):
            it = (row[f"{at}_h1"], row[f"{at}_h2"])
            if it in seen:
                continue
            seen.append(it)
            head, tail = (row[f"{at}_head_no_id"], row[f"{at}_head"]), (row[f"{at}_tail_no_id"], row[f"{at}_tail"])
            if it in runs:
                keeper, last, n = runs[it]
                runs[it] = (keeper, tail, n + row[f"{at}_n"] - (last == head))
            else:
                runs[it] = (head, tail, row[f"{at}_n"])
    return {it: (keeper, n >= LEAST_DOCS) for it, (keeper, _, n) in runs.items()}


def _streamed(edges: dict) -> callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, np.ndarray] | None = None  # rows of the open run while it has too few documents
        known: tuple | None = None  # the open run once it has enough: its key and keeper

        def lost(rows: dict[str, np.ndarray], drop: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(rows[c][drop]) for c in ("doc", "no_id", "row", "pos")], names=["doc", "no_id", "row", "pos"])

        for batch in batches:
            if not batch.num_rows:
                continue
            rows = _arrays(batch)
            if held is not None:
                rows = {c: np.concatenate([held[c], rows[c]]) for c in _COLUMNS}
            key, doc = _changes(rows)
            starts = np.flatnonzero(key)
            run_of = np.cumsum(key) - 1
            nth = np.cumsum(doc) - 1
            nth -= nth[starts][run_of]
            total = np.zeros(len(starts), dtype=np.int64)
            np.maximum.at(total, run_of, nth + 1)
            drop = (nth > 0) & (total >= LEAST_DOCS)[run_of]
            open_from = int(starts[-1])
            for k in {0, len(starts) - 1}:  # only these can be at an edge, or begun before
                a, b = int(starts[k]), int(starts[k + 1]) if k + 1 < len(starts) else len(key)
                it = (int(rows["h1"][a]), int(rows["h2"][a]))
                if known is not None and known[0] == it:
                    keeper, over = known[1], True
                elif it in edges:
                    keeper, over = edges[it]
                else:
                    continue
                drop[a:b] = over & ((rows["doc"][a:b] != keeper[1]) | (rows["no_id"][a:b] != keeper[0]))
                if b == len(key):
                    open_from = len(key)
                    known = (it, keeper) if over else known
            held = None
            if open_from < len(key):
                if total[-1] >= LEAST_DOCS:
                    a = open_from
                    known = ((int(rows["h1"][a]), int(rows["h2"][a])), (bool(rows["no_id"][a]), int(rows["doc"][a])))
                else:  # its first row stands for its first document, which loses nothing
                    wait = np.flatnonzero((np.arange(len(key)) == open_from) | ((np.arange(len(key)) > open_from) & (nth > 0)))
                    held = {c: rows[c][wait] for c in _COLUMNS}
                    drop[open_from:] = False
            yield lost(rows, drop)

    return run


def dropped(docs: DataFrame) -> DataFrame:
    """A row for each line that goes: doc, no_id, row (text hash) and pos."""
    spark = docs.sparkSession
    order = [F.col("h1"), F.col("h2"), F.col("no_id"), F.col("doc").desc(), F.col("row"), F.col("pos")]
    dealt = common.checkpointed(keyed_lines(docs).repartitionByRange(common.partitions_for(spark), *order).sortWithinPartitions(*order))
    edges = _settled(dealt.mapInArrow(_ends, _ENDS).collect())  # one row per partition
    return dealt.mapInArrow(_streamed(edges), _DROPPED)


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for gone in batch.column(3):
            bits = np.ones((max(gone.as_py()) // 8 + 1) * 8, dtype=bool)
            bits[gone.values.to_numpy()] = False
            out.append(zlib.compress(np.packbits(bits).tobytes()))
        yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array([len(set(x.as_py())) for x in batch.column(3)], pa.int64()), pa.array(out, pa.binary())], names=["doc", "no_id", "row", "n_dropped", "keep"])


def keep_bitmaps(docs: DataFrame) -> DataFrame:
    """For each document that loses lines: doc, no_id, row (text hash), n_dropped, and ``keep``.

    ``keep`` is a deflated bitmap over its lines, one bit a line, most significant first, up to the last
    line that goes; later lines stay.
    """
    grouped = dropped(docs).groupBy("doc", "no_id", "row").agg(F.collect_list("pos").alias("gone"))
    return grouped.mapInArrow(_packed, "doc long, no_id boolean, row long, n_dropped long, keep binary")


def kept_lines(text: str | None, keep: bytes | None) -> list[str]:
    """The lines of ``text`` that the bitmap keeps."""
    lines = (text or "").split("\n")
    if keep is None:
        return lines
    bits = np.unpackbits(np.frombuffer(zlib.decompress(keep), dtype=np.uint8))
    gone = set(np.flatnonzero(bits == 0).tolist())
    return [x for i, x in enumerate(lines) if i not in gone]


def _applied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in common.slices(batches, "__text"):
        at = part.schema.get_field_index
        texts, keeps = part.column(at("__text")).to_pylist(), part.column(at("__keep")).to_pylist()
        kept = ["\n".join(kept_lines(t, k)) for t, k in zip(texts, keeps)]
        rest = [c for c in part.schema.names if c not in ("__text", "__keep")]
        yield pa.RecordBatch.from_arrays(
            [
                *(part.column(at(c)) for c in rest),
                pa.array([(t or "").count("\n") + 1 for t in texts], pa.int64()),
                pa.array([None if t is None else x for t, x in zip(texts, kept)], pa.string()),
                pa.array([hashlib.sha256(x.encode()).hexdigest() for x in kept], pa.string()),
            ],
            names=[*rest, "__n_lines", "__kept", "__sha256"],
        )


def applied(docs: DataFrame, *keep: str) -> DataFrame:
    """The columns ``keep`` of each row with __n_lines, __kept (the text left), __sha256 and __n_dropped."""
    common.small_batches(docs)
    bitmaps = keep_bitmaps(docs).select(*(F.col(c).alias(f"__{c}") for c in ("doc", "no_id", "row", "n_dropped", "keep")))
    rows = docs.select(*keep, F.col("text").alias("__text"), F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("__doc"), F.col("doc_id").isNull().alias("__no_id"), _row().alias("__row"))
    joined = rows.join(bitmaps, ["__doc", "__no_id", "__row"], "left").select(*keep, "__text", "__keep", F.coalesce("__n_dropped", F.lit(0)).alias("__n_dropped"))
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in joined.schema if f.name not in ("__text", "__keep")), "__n_lines long, __kept string, __sha256 string"])
    return joined.mapInArrow(_applied, schema)


def deduplicated(docs: DataFrame) -> DataFrame:
    """``docs`` with the lines that go taken out of ``text`` and, where it exists, n_chars brought up to date."""
    out = applied(docs, *(c for c in docs.columns if c != "text"))
    value = {"text": F.col("__kept")}
    if "n_chars" in docs.columns:
        value["n_chars"] = F.length("__kept").cast(docs.schema["n_chars"].dataType)
    return out.select(*(value.get(c, F.col(f"`{c}`")).alias(c) for c in docs.columns))
