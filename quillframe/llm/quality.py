"""Repetition coverage: how much of a text lies inside n-grams and lines that it repeats.

Words are runs of characters other than space and \\t to \\r. A text's words get exact numbers (an
Arrow dictionary), hashes of growing length roll over these numbers in numpy, and every pair of windows
with equal hashes is compared word by word, so no figure depends on a collision. A window of n words
can only repeat if both windows of n - 1 words inside it do, so longer lengths look only at what the
shorter ones left.

Defined results: a null or empty text has no words, fails the base rule and is rejected. Rows are
judged one by one, so repeated rows get equal results; other columns are not read. A text of any
length is judged whole; short texts are worked on together, about two megabytes at a time.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillframe.llm import common

#: Largest share of a text's word characters inside repeated windows, by window length in words.
MOST_NGRAM = {5: 0.25, 6: 0.24, 7: 0.23, 8: 0.22, 9: 0.21, 10: 0.20}
#: Largest share of word characters in lines equal to an earlier one. Their number does not count: a short text between
#: two equal lines is no repetition.
MOST_LINE_CHARS = 0.20
LEAST_WORDS = 10
MOST_REPEAT_PERCENT = 20
BASE = 5

MEASURES = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_lines long, dup_line_chars long, " + ", ".join(f"dup_chars_{n} long" for n in MOST_NGRAM)
_BASE_FACTOR = np.uint64(0x9E3779B97F4A7C15 | 1)
_SYMBOLS = np.zeros(256, dtype=bool)
_SYMBOLS[[ord(c) for c in "#*$%&|<>"]] = True


def _runs(mask: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of true in ``mask``; no run goes on over a cut."""
    if not len(mask):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    first, last = mask.copy(), mask.copy()
    first[1:] &= ~mask[:-1]
    last[:-1] &= ~mask[1:]
    inner = cuts[(cuts > 0) & (cuts < len(mask))]
    first[inner] = mask[inner]
    last[inner - 1] = mask[inner - 1]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def _repeated(at: np.ndarray, keys: np.ndarray, ids: np.ndarray, doc: np.ndarray, n: int) -> np.ndarray:
    """Of the window starts ``at`` with hashes ``keys``: which windows occur twice or more in their text."""
    out = np.zeros(len(at), dtype=bool)
    order = np.argsort(keys)
    ranked = keys[order]
    pair = np.flatnonzero(ranked[1:] == ranked[:-1])
    if not len(pair):
        return out
    a, b = order[pair], order[pair + 1]
    same = doc[at[a]] == doc[at[b]]
    for k in range(n):
        same &= ids[at[a] + k] == ids[at[b] + k]
    if same.all():
        out[a] = out[b] = True
        return out
    clash = np.isin(keys, ranked[pair[~same]])  # two different windows share a hash: tell them apart by their words
    out[a[same]] = out[b[same]] = True
    some = np.flatnonzero(clash)
    rows = np.stack([doc[at[some]], *(ids[at[some] + k] for k in range(n))], axis=1)
    _, inverse, count = np.unique(rows, axis=0, return_inverse=True, return_counts=True)
    out[some] = count[inverse.reshape(-1)] > 1
    return out


def measure(texts: pa.Array) -> dict[str, np.ndarray]:
    """The columns of MEASURES for each text."""
    raw, bounds = common.text_buffer(texts)
    n_docs = len(bounds) - 1
    points = np.zeros(len(raw) + 1, dtype=np.int64)
    np.cumsum((raw & 0xC0) != 0x80, out=points[1:])
    doc_of = lambda at: np.searchsorted(bounds, at, side="right") - 1
    count = lambda doc, by=None: np.bincount(doc, weights=by, minlength=n_docs).astype(np.int64)

    word = ~common.WHITE[raw]
    start, end = _runs(word, bounds)
    doc = doc_of(start)
    chars = points[end] - points[start]
    out = {"n_words": count(doc), "word_chars": count(doc, chars), "n_symbols": count(doc_of(np.flatnonzero(_SYMBOLS[raw])))}

    breaks = np.flatnonzero(raw == 10)
    line_start = np.sort(np.concatenate([bounds[:-1], breaks + 1]))
    line_end = np.sort(np.concatenate([bounds[1:], breaks]))
    line_doc = np.repeat(np.arange(n_docs), 1 + count(doc_of(breaks)))
    words_before = np.zeros(len(raw) + 1, dtype=np.int32)
    words_before[1:] = np.cumsum(word, dtype=np.int32)
    worded = words_before[line_end] > words_before[line_start]
    line_start, line_end, line_doc = line_start[worded], line_end[worded], line_doc[worded]
    line_id = common.exact_ids(common.strings(raw, line_start, line_end))
    _, first = np.unique(np.stack([line_doc, line_id]), axis=1, return_index=True) if len(line_id) else (None, np.zeros(0, np.int64))
    again = np.ones(len(line_id), dtype=bool)
    again[first] = False
    word_points = np.zeros(len(raw) + 1, dtype=np.int64)
    np.cumsum(word & ((raw & 0xC0) != 0x80), out=word_points[1:])
    out |= {"n_lines": count(line_doc), "n_dup_lines": count(line_doc[again]), "dup_line_chars": count(line_doc[again], (word_points[line_end] - word_points[line_start])[again])}

    ids = common.exact_ids(common.strings(raw, start, end))
    code, last = common.mixed(ids), np.append(np.flatnonzero(np.diff(doc)), len(doc) - 1) if len(doc) else np.zeros(0, np.int64)
    room = np.repeat(last, np.diff(np.append(-1, last))) + 1 - np.arange(len(doc))  # words from each to its text's end
    rolled, salt = np.zeros(len(ids), dtype=np.uint64), common.mixed(doc, 7)
    hit = np.ones(len(ids), dtype=bool)
    with np.errstate(over="ignore"):
        for n in range(1, max(MOST_NGRAM) + 1):
            rolled[: len(ids) - n + 1] = rolled[: len(ids) - n + 1] * _BASE_FACTOR + code[n - 1 :] if n <= len(ids) else 0
            if n not in MOST_NGRAM:
                continue
            able = room >= n
            if n > min(MOST_NGRAM):  # both shorter windows repeat
                able &= hit & np.append(hit[1:], False)
            at = np.flatnonzero(able)
            hit = np.zeros(len(ids), dtype=bool)
            hit[at] = _repeated(at, common.mixed(rolled[at]) ^ salt[at], ids, doc, n)
            edge = np.zeros(len(ids) + n, dtype=np.int32)
            found = np.flatnonzero(hit)
            edge[found] += 1
            edge[found + n] -= 1
            covered = np.cumsum(edge[: len(ids)]) > 0
            out[f"dup_chars_{n}"] = count(doc[covered], chars[covered])
            if n == BASE:
                out["n_repeat_words"] = count(doc[covered])
    return out


def _measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [x.split()[0] for x in MEASURES.split(", ")]
    for part in common.slices(batches, "text"):
        found = measure(part.column(part.schema.get_field_index("text")))
        yield pa.RecordBatch.from_arrays([*part.columns, *(pa.array(found[x]) for x in names)], names=[*part.schema.names, *names])


def coverage(docs: DataFrame, *keep: str) -> DataFrame:
    """The columns ``keep`` of each row of ``docs`` with the measures of its ``text`` and the verdict.

    Adds the columns of MEASURES, ``base_failed`` and ``kept``.
    """
    common.small_batches(docs)
    chosen = docs.select(*keep, "text") if "text" not in keep else docs.select(*keep)
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in chosen.schema), MEASURES])
    out = chosen.mapInArrow(_measured, schema)
    if "text" not in keep:
        out = out.drop("text")
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEAT_PERCENT * F.col("n_words"))
    over = F.col("dup_line_chars") > MOST_LINE_CHARS * F.col("word_chars")
    for n, most in MOST_NGRAM.items():
        over = over | (F.col(f"dup_chars_{n}") > most * F.col("word_chars"))
    return out.withColumn("base_failed", failed).withColumn("kept", ~failed & ~over)


def rejected_out(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the rules keep, with the columns of ``docs`` alone."""
    names = [x.split()[0] for x in MEASURES.split(", ")] + ["base_failed", "kept"]
    held = {c: f"__{i}" for i, c in enumerate(docs.columns) if c in names}  # own names that clash wait under others
    judged = coverage(docs.withColumnsRenamed(held), *(held.get(c, c) for c in docs.columns))
    return judged.where("kept").select(*(F.col(f"`{held.get(c, c)}`").alias(c) for c in docs.columns))
