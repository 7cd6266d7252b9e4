"""Toxicity scores by non-negative positive-unlabelled learning.

Confirmed toxic texts and unlabelled text train a logistic model on the presence of hashed character runs
and words. The risk is estimated without negatives: with class prior p, positives as a positive class
weigh p, and the negative class is unlabelled text minus p times positives, a term that may not fall below
zero; where it does, a step undoes it instead (non-negative estimator). Feature scales are the log ratios
of counts under the same correction, and the counts on the unlabelled side are those of all unlabelled text.

The gradient steps see at most ``MOST_POSITIVE`` confirmed and about ``MOST_UNLABELLED`` unlabelled texts,
chosen by a hash of doc_id; the prior is the share of toxic ones among all labelled rows that may be learned
from. What reaches the driver is bounded by these and by the ``2**BITS`` features. Scoring reads every text
whole, with the chosen weights as a closure of at most ``MOST_FEATURES`` numbers.

Defined results: a null or empty text has no features and gets the score of the bias alone. Rows with
equal text get equal scores. A row with null doc_id is scored and never learned from. Labels that are
null are ignored; a doc_id labelled both ways counts as toxic. Without any confirmed text (an empty label
table) all scores are ``NO_MODEL``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillframe.llm import common

FOLDS = 5
BITS = 20
RUNS = (3, 4, 5)
MOST_POSITIVE = 4000
MOST_UNLABELLED = 10000
MOST_FEATURES = 4096
LEAST_COUNT = 3
TRAIN_PARTS = 8
STEPS = 400
RATE = 0.05
DECAY = 1e-4
NO_MODEL = 0.0
_ROLL = np.uint64(0x9E3779B97F4A7C15)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % FOLDS == 0, F.lit(True))


def _points(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Lower-case code points, one space for each run of other characters than letters and digits; text numbers.

    Every text begins and ends with a space.
    """
    parts = [" " + (t or "").lower() + " " for t in texts.to_pylist()]
    points = np.frombuffer("".join(parts).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    doc = np.repeat(np.arange(len(parts), dtype=np.int32), [len(p) for p in parts])
    low = np.flatnonzero(points < 128)
    solid = np.ones(len(points), dtype=bool)
    known = points[low]
    solid[low] = ((known >= 97) & (known <= 122)) | ((known >= 48) & (known <= 57))
    solid[np.isin(points, [0xA0, 0x2019, 0x2018, 0x201C, 0x201D, 0xAB, 0xBB, 0x2013, 0x2014, 0xBF, 0xA1, 0x3002, 0x3000])] = False
    keep = solid.copy()
    keep[0:1] = True
    keep[1:] |= solid[:-1] | (doc[1:] != doc[:-1])
    return np.where(solid, points, 32)[keep].astype(np.uint64), doc[keep]


def features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashed features at every position of every text (with repeats), and their text numbers."""
    points, doc = _points(texts)
    code = common.mixed(points, 1)
    found, owner = [], []
    with np.errstate(over="ignore"):
        h = np.zeros(len(code), dtype=np.uint64)
        for n in range(1, max(RUNS) + 1):
            size = len(code) - n + 1
            if size <= 0:
                break
            h = h[:size] * _ROLL + code[n - 1 :]
            if n in RUNS:
                whole = doc[:size] == doc[n - 1 :]
                found.append((common.mixed(h, n) >> np.uint64(64 - BITS))[whole])
                owner.append(doc[:size][whole])
        space = np.flatnonzero(points == 32)
        first, last = space[:-1] + 1, space[1:]
        word = (last > first) & (doc[space[:-1]] == doc[space[1:]])
        first, last = first[word], last[word]
        total = np.zeros(len(code) + 1, dtype=np.uint64)
        np.cumsum(common.mixed(points * np.uint64(1 << 32), 2), out=total[1:])
        weighted = np.zeros(len(code) + 1, dtype=np.uint64)
        place = np.arange(len(code), dtype=np.uint64)
        np.cumsum(code * (place + np.uint64(1)), out=weighted[1:])
        plain = np.zeros(len(code) + 1, dtype=np.uint64)
        np.cumsum(code, out=plain[1:])
        inside = (weighted[last] - weighted[first]) - (plain[last] - plain[first]) * first.astype(np.uint64)  # sum of code times place in the word
        found.append(common.mixed(inside ^ common.mixed(total[last] - total[first], 4), 6) >> np.uint64(64 - BITS))
        owner.append(doc[first])
    return (np.concatenate(found).astype(np.int64), np.concatenate(owner)) if found else (np.zeros(0, np.int64), np.zeros(0, np.int32))


def present(texts: pa.Array, chosen: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (text number, feature) pairs, by text; only features that ``chosen`` marks."""
    feature, owner = features(texts)
    if chosen is not None:
        some = chosen[feature]
        feature, owner = feature[some], owner[some]
    pair = common.distinct((owner.astype(np.int64) << BITS) | feature)
    return pair >> BITS, pair & ((1 << BITS) - 1)


def _counted(marked: np.ndarray | None) -> callable:
    """How many of the partition's texts have each feature; only those whose bit is set in ``marked``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mark = None if marked is None else np.unpackbits(marked).astype(bool)
        counts = np.zeros(1 << BITS, dtype=np.int64)
        for part in common.slices(batches, "text"):
            counts += np.bincount(present(part.column(0), mark)[1], minlength=1 << BITS)
        seen = np.flatnonzero(counts)
        for at in range(0, len(seen), 1 << 16):
            some = seen[at : at + (1 << 16)]
            yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(counts[some])], names=["feature", "n"])

    return run


def feature_counts(texts: DataFrame, marked: np.ndarray | None = None) -> DataFrame:
    """feature and n: the number of all texts that have it."""
    common.small_batches(texts)
    return texts.select("text").mapInArrow(_counted(marked), "feature long, n long").groupBy("feature").agg(F.sum("n").alias("n"))


def _chosen_only(chosen: np.ndarray) -> callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mark = np.zeros(1 << BITS, dtype=bool)
        mark[chosen] = True
        for part in common.slices(batches, "text"):
            owner, feature = present(part.column(0), mark)
            cuts = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=part.num_rows))]).tolist()
            rows = [np.searchsorted(chosen, feature[a:b]).astype("<u2").tobytes() for a, b in zip(cuts[:-1], cuts[1:])]
            yield pa.RecordBatch.from_arrays([part.column(1), part.column(2), pa.array(rows, pa.binary())], names=["is_positive", "is_unlabelled", "features"])

    return run


class Sparse:
    """Rows of present features, with a scale for each."""

    def __init__(self, rows: list[bytes], scale: np.ndarray):
        found = [np.frombuffer(r, dtype="<u2") for r in rows]
        self.n, self.scale = len(rows), scale
        self.column = np.concatenate([*found, np.zeros(0, "<u2")]).astype(np.int64)
        self.row = np.repeat(np.arange(len(rows)), [len(f) for f in found])

    def dot(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, weights=(w * self.scale)[self.column], minlength=self.n)

    def back(self, g: np.ndarray) -> np.ndarray:
        return np.bincount(self.column, weights=g[self.row], minlength=len(self.scale)) * self.scale


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(z / 2))


def risk(theta: np.ndarray, positive: Sparse, unlabelled: Sparse, prior: float) -> tuple[float, float, np.ndarray]:
    """Logistic risk of positives as positives, corrected risk of the negatives, and the direction of the step.

    theta: weights, and the bias at the end. The direction is the gradient of both parts' sum; where the second
    is below zero, that of its negative alone.
    """
    join = lambda x, g: np.append(x.back(g), g.sum()) / max(1, x.n)
    zp, zu = (x.dot(theta[:-1]) + theta[-1] for x in (positive, unlabelled))
    as_positive = prior * np.logaddexp(0, -zp).mean()
    as_negative = np.logaddexp(0, zu).mean() - prior * np.logaddexp(0, zp).mean()
    toward = join(unlabelled, _sigmoid(zu)) - prior * join(positive, _sigmoid(zp))
    return as_positive, as_negative, -toward if as_negative < 0 else prior * join(positive, _sigmoid(zp) - 1) + toward


def fit(positive: Sparse, unlabelled: Sparse, prior: float) -> tuple[np.ndarray, float]:
    """Weights and bias that make the non-negative risk small, by full-batch Adam steps."""
    theta = np.zeros(len(positive.scale) + 1)
    theta[-1] = np.log(prior / (1 - prior))
    first, second = np.zeros((2, len(theta)))
    for step in range(1, STEPS + 1):
        gradient = risk(theta, positive, unlabelled, prior)[2]
        gradient[:-1] += DECAY * theta[:-1]
        first, second = 0.9 * first + 0.1 * gradient, 0.999 * second + 0.001 * gradient**2
        theta -= RATE * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    return theta[:-1], float(theta[-1])


def trained(docs: DataFrame, labels: DataFrame) -> tuple[np.ndarray, np.ndarray, float] | None:
    """Features, weights and bias; None without confirmed texts. labels: doc_id and toxic."""
    usable = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    n, n_toxic = usable.agg(F.count("*"), F.coalesce(F.sum((F.col("toxic") == 1).cast("long")), F.lit(0))).first()
    if not n_toxic:
        return None
    prior = min(max(n_toxic / n, 1e-4), 1 - 1e-4)
    order = F.xxhash64("doc_id", F.lit("positive"))
    known = usable.where("toxic = 1").orderBy(order, "doc_id").limit(MOST_POSITIVE).select(F.col("doc_id").alias("__id"), F.lit(True).alias("is_positive"))
    share = min(1.0, MOST_UNLABELLED / max(1, docs.count()))
    drawn = ~held_out(F.col("doc_id")) & (F.pmod(F.xxhash64("doc_id", F.lit("unlabelled")), F.lit(1 << 30)) < int(share * (1 << 30)))
    rows = docs.join(F.broadcast(known), F.col("doc_id") == F.col("__id"), "left").select("text", F.coalesce("is_positive", F.lit(False)).alias("is_positive"), drawn.alias("is_unlabelled"))
    sample = common.checkpointed(rows.where("is_positive OR is_unlabelled").repartition(TRAIN_PARTS))
    n_p, n_u = sample.agg(*(F.sum(F.col(c).cast("long")) for c in ("is_positive", "is_unlabelled"))).first()
    if not n_p or not n_u:
        return None
    pool = docs.where(~held_out(F.col("doc_id")))
    chosen, ratio = _features(sample.where("is_positive"), n_p, pool, pool.count(), prior)
    if not len(chosen):
        return chosen, np.zeros(0), float(np.log(prior / (1 - prior)))
    rows = sample.mapInArrow(_chosen_only(chosen), "is_positive boolean, is_unlabelled boolean, features binary").collect()  # the bounded sample
    positive, unlabelled = (Sparse([r["features"] for r in rows if r[k]], ratio) for k in ("is_positive", "is_unlabelled"))
    weights, bias = fit(positive, unlabelled, prior)
    return chosen, weights * ratio, bias


def _features(positive: DataFrame, n_p: int, pool: DataFrame, n_u: int, prior: float) -> tuple[np.ndarray, np.ndarray]:
    """The features by which confirmed texts differ most from all unlabelled ones, and their log ratios.

    What confirmed texts have at all is counted first, so that only those features are counted in the whole pool;
    both tables have at most 2**BITS rows.
    """
    found = feature_counts(positive).where(F.col("n") >= LEAST_COUNT).collect()
    p, u, mark = (np.zeros(1 << BITS, dtype=t) for t in (np.int64, np.int64, bool))
    for r in found:
        p[r["feature"]], mark[r["feature"]] = r["n"], True
    if found:
        for r in feature_counts(pool, np.packbits(mark)).collect():
            u[r["feature"]] = r["n"]
    some = np.flatnonzero(mark)
    share_p, share_u = (p[some] + 0.5) / (n_p + 1), (u[some] + 0.5) / (n_u + 1)
    share_n = np.maximum(share_u - prior * share_p, 0) / (1 - prior) + 0.5 / (n_u + 1)
    pooled = (n_p * share_p + n_u * share_u) / (n_p + n_u)
    gain = (share_p - share_u) / np.sqrt(np.maximum(pooled * (1 - pooled), 1e-9))
    ratio = np.log(share_p / share_n)
    best = np.flatnonzero((ratio > 0) & (gain > 0))
    best = np.sort(best[np.lexsort((some[best], -gain[best]))[:MOST_FEATURES]])
    return some[best], ratio[best]


def scored(docs: DataFrame, model: tuple[np.ndarray, np.ndarray, float] | None, *keep: str) -> DataFrame:
    """The columns ``keep`` of each row with __score (0 to 1)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if model is not None:
            mark, weight = np.zeros(1 << BITS, dtype=bool), np.zeros(1 << BITS)
            mark[model[0]], weight[model[0]] = True, model[1]
        for part in common.slices(batches, "__text", 1 << 20):
            at = part.schema.get_field_index("__text")
            score = np.full(part.num_rows, NO_MODEL)
            if model is not None:
                owner, feature = present(part.column(at), mark)
                score = _sigmoid(np.bincount(owner, weights=weight[feature], minlength=part.num_rows) + model[2])
            rest = [c for c in part.schema.names if c != "__text"]
            yield pa.RecordBatch.from_arrays([*(part.column(c) for c in rest), pa.array(score)], names=[*rest, "__score"])

    common.small_batches(docs)
    chosen = docs.select(*keep, F.col("text").alias("__text"))
    return chosen.mapInArrow(run, ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in chosen.schema if f.name != "__text"), "__score double"]))
