"""Toxicity: a linear classifier of character n-grams, scaled by naive Bayes log-count ratios.

A text is the set of its character n-grams, hashed to ``SLOTS`` places. The log-count ratio of a place compares how often
toxic and other labelled texts have it, with all labelled texts counted on the cluster. A text's features are the ratios of its
places; a logistic regression on them, of strength ``ridge``, is fitted on a bounded sample of labelled texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window, functions as F

from tallyloom.llm.common import saved, text_slices

#: Places of the hashed n-grams, a fixed number; n-gram sizes in bytes of the lower-cased text.
SLOTS, SIZES = 1 << 20, (4, 5, 6)
#: Labelled texts of each class that the regression is fitted on at most, the least by hash of the text.
SAMPLE_PER_CLASS = 600
#: Of these as many, in that order, as hold so many bytes of text; the first one in any case.
SAMPLE_BYTES = 32 << 20
_BASE, _MIX = np.uint32(0x9E3779B1), np.uint32(0x85EBCA6B)


@dataclass
class Model:
    weights: np.ndarray
    bias: float

    def score(self, places: np.ndarray) -> float:
        return float(1.0 / (1.0 + np.exp(-np.clip(self.weights[places].sum(dtype=np.float64) + self.bias, -30, 30))))


def places_of(text: bytes, stamps: np.ndarray) -> np.ndarray:
    """The different places of a text; ``stamps`` is an int32 array of SLOTS for use over and over."""
    data = np.frombuffer(b" " + text + b" ", np.uint8).astype(np.uint32)
    found = []
    with np.errstate(over="ignore"):
        hashed, done = data, 1
        for size in SIZES:
            if len(data) < size:
                break
            while done < size:
                hashed = hashed[:-1] * _BASE + data[done:]
                done += 1
            found.append(((hashed ^ (hashed >> np.uint32(15))) * _MIX) >> np.uint32(32 - SLOTS.bit_length() + 1))
    if not found:
        return np.zeros(0, np.int64)
    places = np.concatenate(found).astype(np.int64)
    order = np.arange(len(places), dtype=np.int32)
    stamps[places] = order
    return places[stamps[places] == order]  # of equal places the one that was written last


def _lowered(text: str | None) -> bytes:
    return (text or "").lower().encode("utf-8", "surrogatepass")


def train(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text", label_column: str = "toxic", ridge: float = 1.0, smoothing: float = 1.0, sample_per_class: int = SAMPLE_PER_CLASS) -> Model:
    """Learn from the labelled rows: counts from all, the regression from a sample of ``sample_per_class`` per class.

    Rows without a text, a label of 0 or 1, or an id are passed over; a document's repeated labels count each. The labelled texts are
    joined and read once: each task hands on its counts and its least texts by hash, at most ``sample_per_class`` of a class and
    ``SAMPLE_BYTES`` of text. The regression is fitted in one task, whose memory these bounds limit; the driver only gets its
    weights, a fixed number.
    Without rows of both classes the model gives every text the share of label 1 (one half without labels).
    """
    known = labels.where(F.col(label_column).isin(0, 1)).select(F.col(id_column).alias("id"), F.col(label_column).cast("int").alias("label"))
    texts = docs.where(F.col(text_column).isNotNull()).select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    # dealt by id at every size, so that the cost keeps its proportion to the input
    rows = texts.join(known.hint("merge"), "id").select("text", "label", F.xxhash64("text").alias("order"))

    def least(held: list[tuple[int, str]]) -> list[tuple[int, str]]:
        kept = sorted(held)[:sample_per_class]
        sizes = np.cumsum([len(text.encode()) for _, text in kept])
        return kept[: max(1, int(np.searchsorted(sizes, SAMPLE_BYTES, "right")))]

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The counts of a task's texts, and those of them that the sample may take: the only pass over the texts."""
        stamps, counts, total = np.zeros(SLOTS, np.int32), np.zeros((2, SLOTS), np.int32), [0, 0]
        held: list[list[tuple[int, str]]] = [[], []]
        pack = zstandard.ZstdCompressor(level=3)
        for batch in text_slices(batches, "text"):
            for text, label, order in zip(batch["text"].to_pylist(), batch["label"].to_pylist(), batch["order"].to_pylist()):
                counts[label][places_of(_lowered(text), stamps)] += 1
                total[label] += 1
                held[label].append((order, text))
                if len(held[label]) > 2 * sample_per_class:
                    held[label] = least(held[label])
        for label in (0, 1):
            for low in range(0, SLOTS if total[label] else 0, 1 << 15):
                yield pa.RecordBatch.from_pylist([{"label": label, "low": low, "n": total[label], "counts": pack.compress(counts[label][low : low + (1 << 15)].tobytes()), "order": None, "text": None}], kinds)
            for order, text in least(held[label]):
                yield pa.RecordBatch.from_pylist([{"label": label, "low": None, "n": None, "counts": None, "order": order, "text": text}], kinds)

    def add(group: pa.Table) -> pa.Table:
        unpack = zstandard.ZstdDecompressor()
        total = sum(np.frombuffer(unpack.decompress(c), "<i4").astype(np.int64) for c in group["counts"].to_pylist())
        return pa.table({"label": group["label"][:1], "low": group["low"][:1], "n": pa.array([sum(group["n"].to_pylist())]), "counts": pa.array([total.astype("<i8").tobytes()], pa.binary())})

    kinds = pa.schema([("label", pa.int64()), ("low", pa.int64()), ("n", pa.int64()), ("counts", pa.binary()), ("order", pa.int64()), ("text", pa.string())])
    gathered = saved(rows.mapInArrow(gather, "label long, low long, n long, counts binary, order long, text string"), "labelled")
    parts = gathered.where("low IS NOT NULL").select("label", "low", "n", "counts").groupBy("label", "low").applyInArrow(add, "label long, low long, n long, counts binary")

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The model from all counts and the sample, in one task."""
        counts, total, stamps = np.zeros((2, SLOTS), np.int64), [0, 0], np.zeros(SLOTS, np.int32)
        sample: list[tuple[int, int, bytes, np.ndarray]] = []
        for batch in batches:
            for row in batch.to_pylist():
                if row["low"] is None:
                    text = _lowered(row["text"])
                    sample.append((row["label"], row["order"], text, places_of(text, stamps).astype("<i4")))
                else:
                    own = np.frombuffer(row["counts"], "<i8")
                    counts[row["label"]][row["low"] : row["low"] + len(own)] = own
                    total[row["label"]] = row["n"]
        if all(total):
            ratio = np.log((counts[1] + smoothing) / (total[1] + 2 * smoothing)) - np.log((counts[0] + smoothing) / (total[0] + 2 * smoothing))
            sample.sort(key=lambda r: r[:3])
            weights, bias = _fitted([(label, places) for label, _, _, places in sample], ratio.astype(np.float32), total, ridge)
        else:
            share = (total[1] + 0.5) / (sum(total) + 1)
            weights, bias = np.zeros(SLOTS, np.float32), float(np.log(share / (1 - share)))
        for low in range(0, SLOTS, 1 << 17):
            yield pa.RecordBatch.from_pylist([{"low": low, "weights": weights[low : low + (1 << 17)].astype("<f4").tobytes(), "bias": bias}])

    given = parts.select("label", "low", "n", "counts", F.lit(None).cast("long").alias("order"), F.lit(None).cast("string").alias("text"))
    so_far = Window.partitionBy("label").orderBy("order", "text")
    for label in (0, 1):
        # the window has sample_per_class rows
        chosen = gathered.where(F.col("low").isNull() & (F.col("label") == label)).orderBy("order", "text").limit(sample_per_class)
        held = F.sum(F.octet_length("text")).over(so_far) <= SAMPLE_BYTES
        given = given.unionByName(chosen.withColumns({"_held": held, "_place": F.row_number().over(so_far)}).where("_held OR _place = 1").drop("_held", "_place"))
    weights, bias = np.zeros(SLOTS, np.float32), 0.0
    for row in given.repartition(1).mapInArrow(fit, "low long, weights binary, bias double").toLocalIterator():
        own = np.frombuffer(row["weights"], "<f4")
        weights[row["low"] : row["low"] + len(own)] = own
        bias = row["bias"]
    return Model(weights, bias)


def _fitted(sample: list[tuple[int, np.ndarray]], ratio: np.ndarray, total: list[int], ridge: float) -> tuple[np.ndarray, float]:
    """Weights (ratio times coefficient) and bias, by full-batch steps with momentum.

    Texts are weighted so that each class counts as in the labels.
    """
    y = np.array([label for label, _ in sample], np.float64)
    sizes = np.array([len(p) for _, p in sample])
    flat, owner = np.concatenate([p for _, p in sample]), np.repeat(np.arange(len(sample)), sizes)
    weight = np.where(y == 1, total[1] / max(1, (y == 1).sum()), total[0] / max(1, (y == 0).sum()))
    weight /= weight.sum()
    x = ratio[flat]
    coefficient, bias = np.zeros(SLOTS), float(np.log(total[1] / total[0]))
    scale = np.bincount(owner, x * x, len(sample))
    step = 4.0 / (np.average(scale, weights=weight) + 1)
    previous, prior_bias = coefficient, bias
    for k in range(40):
        ahead, ahead_bias = coefficient + (k / (k + 3)) * (coefficient - previous), bias + (k / (k + 3)) * (bias - prior_bias)
        margin = np.bincount(owner, x * ahead[flat], len(sample)) + ahead_bias
        error = weight * (1 / (1 + np.exp(-np.clip(margin, -30, 30))) - y)
        slope = np.bincount(flat, x * error[owner], SLOTS) + ridge / sum(total) * ahead
        previous, prior_bias = coefficient, bias
        coefficient, bias = ahead - step * slope, ahead_bias - step * error.sum()
    return (ratio * coefficient).astype(np.float32), float(bias)


def score(docs: DataFrame, model: Model, text_column: str = "text", threshold: float = 0.3) -> DataFrame:
    """All rows and columns of ``docs`` (in the struct ``row``) with score (0 to 1) and predicted (1 from ``threshold`` on).

    Whole texts are scored; a null text counts as empty, whose score is that of a text without n-grams.
    """
    shared = docs.sparkSession.sparkContext.broadcast((model.weights, model.bias))  # 4 x SLOTS bytes

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, stamps = Model(*shared.value), np.zeros(SLOTS, np.int32)
        for batch in text_slices(batches, "text"):
            values = pa.array([own.score(places_of(_lowered(t), stamps)) for t in batch["text"].to_pylist()], pa.float64())
            yield pa.RecordBatch.from_arrays([batch["row"], values], ["row", "score"])

    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), F.col(text_column).cast("string").alias("text"))
    scored = rows.mapInArrow(judge, rows.select("row", F.lit(0.0).cast("double").alias("score")).schema)
    return scored.select("row", "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
