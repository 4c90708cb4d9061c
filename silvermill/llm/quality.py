"""A quality classifier: naive Bayes support vectors over n-gram indicators.

A text's features are the n-grams that occur in it: runs of 1 to 3 bytes, and
runs of 1 to 3 word shapes (which say what kinds of characters a word has and
whether it repeats the word before). Features are hashed to 2^`bits` places.
Each is scaled by its log-count ratio between the classes, counted over all
labelled training documents; a linear hinge-loss model on the scaled features is
fitted by dual coordinate descent on a bounded sample of them. A logistic curve
fitted to held-in margins turns margins into scores.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from silvermill.llm.text import raw_texts, whole_text
from silvermill.scratch import stored

ORDERS = 3
#: Character kinds: others, digit, lower, upper, not ASCII.
_KIND = np.zeros(256, np.uint8)
_KIND[48:58], _KIND[97:123], _KIND[65:91], _KIND[128:] = 1, 2, 3, 4
_BREAK = np.zeros(256, bool)
_BREAK[[32, 9, 10, 11, 12, 13]] = True


def features(raw: np.ndarray, bits: int) -> np.ndarray:
    """The sorted, distinct feature numbers of a whole text in UTF-8."""
    seen = np.zeros(1 << bits, bool)
    if not len(raw):
        return np.zeros(0, np.int32)
    codes = raw.astype(np.uint32)
    run = np.zeros(len(raw), np.uint32)
    for order in range(1, min(ORDERS, len(raw)) + 1):
        run = (run[: len(raw) - order + 1] << np.uint32(8)) | codes[order - 1 :]
        _mark(seen, run, order, bits)
    shapes = word_shapes(raw)
    run = np.zeros(len(shapes), np.uint32)
    for order in range(1, min(ORDERS, len(shapes)) + 1):
        run = (run[: len(shapes) - order + 1] << np.uint32(10)) | shapes[order - 1 :]
        _mark(seen, run, 8 + order, bits)
    return np.flatnonzero(seen).astype(np.int32)


def _mark(seen: np.ndarray, run: np.ndarray, kind: int, bits: int) -> None:
    run = (run ^ np.uint32(kind * 0x9E3779B1 & 0xFFFFFFFF)) * np.uint32(0x85EBCA6B)
    run = (run ^ (run >> np.uint32(15))) * np.uint32(0xC2B2AE35)
    seen[run >> np.uint32(32 - bits)] = True


def word_shapes(raw: np.ndarray) -> np.ndarray:
    """Ten bits for each word: kinds of its first, last and other characters, length, repeat."""
    gap = _BREAK[raw]
    start = np.flatnonzero(~gap & np.concatenate([[True], gap[:-1]]))
    if not len(start):
        return np.zeros(0, np.uint32)
    end = np.flatnonzero(~gap & np.concatenate([gap[1:], [True]]))
    kind = _KIND[raw]
    length = end - start
    shape = np.minimum(length.astype(np.uint32) // 4, 3)
    shape |= (kind[start] == 3).astype(np.uint32) << np.uint32(2)
    shape |= np.minimum(kind[end], 3).astype(np.uint32) << np.uint32(3)
    inner = np.minimum(start + 1, end)
    shape |= np.minimum(kind[inner], 3).astype(np.uint32) << np.uint32(5)
    word = np.maximum(np.cumsum(~gap & np.concatenate([[True], gap[:-1]])) - 1, 0)
    place = (np.arange(len(raw)) - start[word]) & 63
    power = np.cumprod(np.full(64, 0x9E3779B97F4A7C15, np.uint64))
    weight = np.where(gap, np.uint64(0), power[place] * (raw.astype(np.uint64) + np.uint64(1)))
    total = np.add.reduceat(weight, start)
    same = np.concatenate([[False], (total[1:] == total[:-1]) & (length[1:] == length[:-1])])
    twice = same & np.concatenate([[False], same[:-1]])
    shape |= same.astype(np.uint32) << np.uint32(7)
    shape |= twice.astype(np.uint32) << np.uint32(8)
    shape |= (kind[end] == 0).astype(np.uint32) << np.uint32(9)
    return shape


def is_held_out(id_column: Column, parts: int = 4, part: int = 2) -> Column:
    """Whether the id's text has CRC-32 `part` modulo `parts`; false for null."""
    return F.coalesce(F.crc32(id_column.cast("string")) % parts == part, F.lit(False))


@dataclass(frozen=True)
class QualityModel:
    """For each feature its weight and the square of its ratio; offset; logistic curve."""

    bits: int
    weights: np.ndarray
    bias: float
    slope: float
    centre: float


def dual_coordinate_descent(
    rows: list[np.ndarray], scale: np.ndarray, labels: np.ndarray, costs: np.ndarray,
    passes: int, seed: int = 0,
) -> tuple[np.ndarray, float]:
    """Weights and offset of the hinge-loss model of rows of feature numbers.

    Row i is x = scale[rows[i]] / its norm, and 1 for the offset. The dual of
    0.5 |w|^2 + sum of costs * hinge is solved one multiplier at a time.
    """
    w, bias = np.zeros(len(scale)), 0.0
    norms = np.array([np.linalg.norm(scale[r]) for r in rows])
    square = np.where(norms > 0, 2.0, 1.0)
    norms[norms == 0] = 1.0
    alpha = np.zeros(len(rows))
    draw = np.random.default_rng(seed)
    for _ in range(passes):
        moved = 0.0
        for i in draw.permutation(len(rows)):
            values = scale[rows[i]] / norms[i]  # made anew: kept, they are the largest thing here
            gradient = labels[i] * (w[rows[i]] @ values + bias) - 1
            new = min(max(alpha[i] - gradient / square[i], 0.0), costs[i])
            step = (new - alpha[i]) * labels[i]
            if step:
                alpha[i] = new
                w[rows[i]] += step * values
                bias += step
                moved = max(moved, abs(step))
        if moved < 1e-3:
            break
    return w, bias


def logistic_curve(margins: np.ndarray, labels: np.ndarray, rounds: int = 50) -> tuple[float, float]:
    """slope and centre of P(1) = 1 / (1 + exp(-(slope * margin + centre)))."""
    up, down = (labels > 0).sum(), (labels < 0).sum()
    goal = np.where(labels > 0, (up + 1) / (up + 2), 1 / (down + 2))
    a, b = 1.0, 0.0
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(a * margins + b, -30, 30)))
        g = np.array([((p - goal) * margins).sum(), (p - goal).sum()])
        s = p * (1 - p) + 1e-9
        h = np.array([[(s * margins**2).sum(), (s * margins).sum()], [(s * margins).sum(), s.sum()]])
        step = np.linalg.solve(h + 1e-6 * np.eye(2), g)
        a, b = a - step[0], b - step[1]
        if np.abs(step).max() < 1e-8:
            break
    return (float(a), float(b)) if a > 0 else (1.0, 0.0)


def train_quality(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    label_col: str = "quality", bits: int = 17, max_examples: int = 6_000,
    cost: float = 1.0, passes: int = 15, smoothing: float = 1.0,
) -> QualityModel:
    """The model of `labels` (1 good, 0 bad), without the ids that are held out.

    Counts for the log-count ratios cover every training document; the linear
    model is fitted on the `max_examples` of them whose ids hash lowest (all, if
    there are fewer). The driver gets 2^bits counts and the sample's feature
    numbers, both bounded by parameters. Labels other than 0 and 1, null ids,
    and ids with contradicting labels are left out; a label given twice counts
    once. Without both classes there is no model to fit: every score is 0.5 or
    the one class that is there.
    """
    spark = docs.sparkSession
    known = (
        labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label"))
        .where(F.col("id").isNotNull() & F.col("label").isin(0, 1) & ~is_held_out(F.col("id")))
        .groupBy("id").agg(F.min("label").alias("label"), F.max("label").alias("other"))
        .where(F.col("label") == F.col("other")).select("id", "label")
    )
    order = F.xxhash64(F.lit("sample"), F.col("id"))
    texts = docs.select(F.col(id_col).alias("id"), whole_text(text_col).alias("text"))
    total = known.count()
    # a little over the wanted share, so that the lowest `max_examples` are among them
    share = min(1.0, 1.5 * max_examples / max(total, 1) + 50 / max(total, 1))
    edge = int(-(2**63) + share * (2**64 - 1))
    chosen = (order <= F.lit(min(edge, 2**63 - 1))).alias("chosen")

    names = ["feature", "bad", "good", "row"]
    kinds = pa.schema([(name, pa.int64()) for name in names[:3]] + [("row", pa.binary())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((2, 1 << bits), np.int64)
        sizes = np.zeros(2, np.int64)
        for batch in batches:
            labels, places = batch["label"].to_numpy(), batch["place"].to_numpy()
            taken = batch["chosen"].to_numpy(zero_copy_only=False)
            samples = []
            for i, raw in enumerate(raw_texts(batch["text"])):
                found = features(raw, bits)
                counts[labels[i], found] += 1
                sizes[labels[i]] += 1
                if taken[i]:
                    samples.append((-2, int(labels[i]), int(places[i]), found.tobytes()))
            if samples:
                yield pa.record_batch(list(map(list, zip(*samples))), schema=kinds)
        used = np.flatnonzero(counts.any(axis=0))
        yield pa.record_batch([
            np.append(used, -1), np.append(counts[0, used], sizes[0]),
            np.append(counts[1, used], sizes[1]), pa.nulls(len(used) + 1, pa.binary()),
        ], schema=kinds)

    # one plan for all sizes: labels grow with the documents, and small ones would
    # otherwise be broadcast
    counted = stored(
        texts.join(known.hint("merge"), "id")
        .select("text", "label", chosen, order.alias("place"))
        .mapInArrow(count, "feature long, bad long, good long, row binary"),
        "quality-counts",
    )
    sums = (
        counted.where(F.col("feature") >= -1).groupBy("feature")
        .agg(F.sum("bad").alias("bad"), F.sum("good").alias("good")).toPandas()
    )
    sample = (
        counted.where(F.col("feature") == -2).orderBy("good").limit(max_examples)
        .select("bad", "row").toArrow()
    )
    return _fit(sums, sample, bits, cost, passes, smoothing)


def _fit(sums, sample, bits, cost, passes, smoothing) -> QualityModel:
    counts = np.zeros((2, 1 << bits))
    at = sums["feature"].to_numpy(np.int64)
    inside = at >= 0
    counts[0, at[inside]] = sums["bad"].to_numpy()[inside]
    counts[1, at[inside]] = sums["good"].to_numpy()[inside]
    bad = float(sums["bad"][~inside].sum())
    good = float(sums["good"][~inside].sum())
    labels = 2.0 * sample["bad"].to_numpy() - 1
    if not len(labels) or len(set(labels)) < 2:
        flat = 0.5 if not len(labels) else float(labels[0] > 0)
        centre = {0.0: -10.0, 0.5: 0.0, 1.0: 10.0}[flat]
        return QualityModel(bits, np.zeros((2, 1 << bits)), 0.0, 1.0, centre)
    rate = (counts + smoothing) / (np.array([[bad], [good]]) + 2 * smoothing)
    ratio = np.log(rate[1]) - np.log(rate[0])
    rows = [np.frombuffer(row, np.int32) for chunk in sample["row"].chunks for row in raw_texts(chunk)]
    share = np.array([(labels < 0).mean(), (labels > 0).mean()])
    costs = np.where(labels > 0, cost * 0.5 / share[1], cost * 0.5 / share[0])
    # the curve needs margins of rows that the model has not seen: two halves
    margins = np.zeros(len(rows))
    half = np.arange(len(rows)) % 2
    for side in (0, 1):
        train = np.flatnonzero(half != side)
        if len(set(labels[train])) < 2:
            train = np.arange(len(rows))
        w, b = dual_coordinate_descent([rows[i] for i in train], ratio, labels[train], costs[train], passes)
        for i in np.flatnonzero(half == side):
            margins[i] = _margin(rows[i], ratio, w, b)
    slope, centre = logistic_curve(margins, labels)
    w, b = dual_coordinate_descent(rows, ratio, labels, costs, passes)
    return QualityModel(bits, np.stack([w * ratio, ratio * ratio]), b, slope, centre)


def _margin(row: np.ndarray, ratio: np.ndarray, w: np.ndarray, bias: float) -> float:
    x = ratio[row]
    return float(w[row] @ x / (np.linalg.norm(x) or 1.0) + bias)


def score_quality(
    docs: DataFrame, model: QualityModel, text_col: str = "text",
    score_col: str = "score", predicted_col: str = "predicted", threshold: float = 0.7,
) -> DataFrame:
    """The rows with a score from 0 to 1 (higher: better) and predicted 0 or 1.

    Scores depend on the whole text alone; null texts count as empty and are
    scored too. Columns of the added names are replaced.
    """
    plain = (model.bits, model.weights, model.bias, model.slope, model.centre)
    shared = docs.sparkSession.sparkContext.broadcast(plain)

    @F.arrow_udf("double")
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        bits, weights, bias, slope, centre = shared.value
        linear, squares = weights
        for texts in batches:
            margins = np.empty(len(texts))
            for i, raw in enumerate(raw_texts(texts)):
                row = features(raw, bits)
                margins[i] = linear[row].sum() / (np.sqrt(squares[row].sum()) or 1.0) + bias
            yield pa.array(1 / (1 + np.exp(-np.clip(slope * margins + centre, -30, 30))))

    scored = docs.withColumn(score_col, score(whole_text(text_col)))
    return scored.withColumn(predicted_col, F.when(F.col(score_col) >= threshold, 1).otherwise(0))
