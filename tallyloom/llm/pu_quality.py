"""Quality classifier from positive and unlabelled texts.

Trusted texts are positives; everything else is unlabelled web text, good and bad mixed.
A small network is trained to minimise the non-negative unbiased risk

    pi * E_P[l(+f)] + max(0, E_U[l(-f)] - pi * E_P[l(-f)])

where ``pi``, the share of positives among the unlabelled, is estimated: a first
classifier separates positives from unlabelled, and where its scores are best the
unlabelled are as dense as ``pi`` times the positives.

Labels train on a sample of bounded size (``SAMPLE`` texts of each kind, those with the
smallest hash of their id); every text is scored, whole, by features of its words.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.llm import blocks
from tallyloom.llm.target_llr import repeated_words

#: Texts of each kind that the network is trained on, at most.
SAMPLE = 20_000
HIDDEN, EPOCHS, BATCH, RATE = 24, 40, 256, 0.01
FEATURES = [
    "log_words", "chars_per_word", "symbols", "uppers", "digits", "marks", "others", "shouted", "with_symbol",
    "letterless", "capitalised", "long", "short", "exclaimed", "same_as_before", "distinct", "repeated",
    "dup_lines", "words_per_line",
]

_CLASS = np.zeros(256, np.uint8)  # 0 white space
_CLASS[33:127] = 5
_CLASS[ord("a"):ord("z") + 1] = 1
_CLASS[ord("A"):ord("Z") + 1] = 2
_CLASS[ord("0"):ord("9") + 1] = 3
_CLASS[[*b"#*$%&|<>@^~`{}[]\\_+="]] = 4
_CLASS[1:9] = _CLASS[14:32] = _CLASS[127] = 5
_CLASS[128:] = 6


def features(texts: list[bytes | None]) -> np.ndarray:
    """One row of numbers per text; all zero for a text without words."""
    words, bounds = blocks.word_hashes(texts)
    n = np.diff(bounds)
    many = np.maximum(n, 1)
    data = np.frombuffer(b"\n".join([t or b"" for t in texts]) + b"\n", np.uint8)
    kind = np.where(blocks._IS_SPACE[data], 0, np.maximum(_CLASS[data], 1))
    inside = np.concatenate(([False], kind > 0, [False]))
    edge = np.flatnonzero(inside[1:] != inside[:-1])
    start, end = edge[0::2], edge[1::2]

    def within(flags: np.ndarray) -> np.ndarray:
        total = np.concatenate(([0], np.cumsum(flags, dtype=np.int32)))
        return total[end] - total[start]

    size = end - start
    lower, upper, digit, symbol, mark, other = (within(kind == k) for k in range(1, 7))
    letters = lower + upper + other
    by_text = lambda flags: blocks.per_text(flags, bounds)
    chars = np.maximum(by_text(size), 1)
    first_upper = kind[start] == 2 if len(start) else np.zeros(0, bool)
    exclaimed = (data[end - 1] == ord("!")) & (size > 2) & (data[end - 2] == ord("!")) if len(end) else first_upper
    again = np.concatenate(([False], words[1:] == words[:-1]))[:len(words)]
    again[bounds[:-1][n > 0]] = False  # the word before is another text's
    owner = np.repeat(np.arange(len(texts)), n)
    order = np.lexsort((words, owner))
    new = np.concatenate(([True], (words[order][1:] != words[order][:-1]) | (owner[order][1:] != owner[order][:-1])))
    distinct = np.bincount(owner[order][new[:len(words)]], minlength=len(texts))
    lines, dups = np.ones(len(texts)), np.zeros(len(texts))
    for i, text in enumerate(texts):
        filled = [line for line in (text or b"").split(b"\n") if line.strip(blocks.WHITE)]
        lines[i] = max(1, len(filled))
        dups[i] = len(filled) - len(set(filled))
    shares = [
        np.log1p(n), by_text(size) / many / 10, by_text(symbol) / chars, by_text(upper) / chars,
        by_text(digit) / chars, by_text(mark) / chars, by_text(other) / chars,
        by_text((upper > 1) & (lower == 0)) / many, by_text(symbol > 0) / many, by_text(letters == 0) / many,
        by_text(first_upper) / many, by_text(size > 8) / many, by_text(size <= 3) / many, by_text(exclaimed) / many,
        by_text(again) / many, distinct / many, repeated_words(words, bounds) / many, dups / lines,
        np.log1p(n / lines),
    ]
    table = np.array(shares, np.float64).T
    table[n == 0] = 0
    return table


def _numbers(texts: DataFrame) -> DataFrame:
    """The columns of ``texts`` but the text, and its features as an array."""
    names = [c for c in texts.columns if c != "text"]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks.blocks(batches):
            table = features(blocks.raw(block))
            offsets = np.arange(0, table.size + 1, table.shape[1], dtype=np.int32)
            yield pa.RecordBatch.from_arrays(
                [*(block.column(c) for c in names), pa.ListArray.from_arrays(offsets, pa.array(table.ravel()))],
                [*names, "features"])

    schema = [f"`{f.name}` {f.dataType.simpleString()}" for f in texts.schema if f.name != "text"]
    return texts.mapInArrow(count, ", ".join([*schema, "features ARRAY<DOUBLE>"]))


@dataclass(frozen=True)
class Network:
    """One hidden layer on standardised features."""

    mean: np.ndarray
    scale: np.ndarray
    weights: tuple[np.ndarray, ...]
    prior: float

    def score(self, table: np.ndarray) -> np.ndarray:
        """Chance of the positive class for each row."""
        return 1 / (1 + np.exp(-np.clip(_forward(self.weights, self._scaled(table))[1], -40, 40)))

    def _scaled(self, table: np.ndarray) -> np.ndarray:
        return np.clip((table - self.mean) / self.scale, -6, 6)


def _forward(weights, x):
    inner = np.maximum(x @ weights[0] + weights[1], 0)
    return inner, inner @ weights[2] + weights[3]


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def nn_pu_gradient(f_p: np.ndarray, f_u: np.ndarray, prior: float) -> tuple[np.ndarray, np.ndarray, bool]:
    """Derivatives of the non-negative risk (logistic loss) by the outputs of positives
    and unlabelled. Where the estimated risk of the negatives is below 0 the step goes
    back on that part alone."""
    loss_neg = lambda f: np.logaddexp(0, f)
    negative = loss_neg(f_u).mean() - prior * loss_neg(f_p).mean()
    down_p = -prior * _sigmoid(-f_p) / len(f_p)
    back_p, up_u = -prior * _sigmoid(f_p) / len(f_p), _sigmoid(f_u) / len(f_u)
    if negative < 0:
        return -back_p, -up_u, False
    return down_p + back_p, up_u, True


def _train(p: np.ndarray, u: np.ndarray, prior: float | None, epochs: int) -> tuple[np.ndarray, ...]:
    """Weights after Adam steps; without a prior, plain positives against unlabelled."""
    rng = np.random.default_rng(2)
    size = p.shape[1]
    weights = [rng.normal(0, np.sqrt(2 / size), (size, HIDDEN)), np.zeros(HIDDEN),
               rng.normal(0, 1 / np.sqrt(HIDDEN), HIDDEN), np.zeros(1)]
    first, second, step = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights], 0
    rounds = max(1, len(u) // BATCH)
    for epoch in range(epochs):
        rate = RATE * 0.5 * (1 + np.cos(np.pi * epoch / epochs))
        for _ in range(rounds):
            x_p, x_u = p[rng.integers(0, len(p), BATCH)], u[rng.integers(0, len(u), BATCH)]
            x = np.concatenate((x_p, x_u))
            inner, f = _forward(weights, x)
            if prior is None:
                slope = np.concatenate((-_sigmoid(-f[:BATCH]), _sigmoid(f[BATCH:]))) / BATCH
            else:
                slope = np.concatenate(nn_pu_gradient(f[:BATCH], f[BATCH:], prior)[:2])
            back = np.outer(slope, weights[2]) * (inner > 0)
            step += 1
            for i, g in enumerate((x.T @ back, back.sum(0), inner.T @ slope, slope.sum(keepdims=True))):
                g = g + 1e-4 * weights[i]
                first[i] = 0.9 * first[i] + 0.1 * g
                second[i] = 0.999 * second[i] + 0.001 * g * g
                weights[i] = weights[i] - rate * first[i] / (1 - 0.9**step) / (
                    np.sqrt(second[i] / (1 - 0.999**step)) + 1e-8)
    return tuple(weights)


def estimate_prior(score_p: np.ndarray, score_u: np.ndarray) -> float:
    """Share of positives among the unlabelled: the least ratio of the two upper tails,
    with an allowance for their being samples."""
    cuts = np.quantile(score_p, np.linspace(0.02, 0.9, 45))
    top_p = 1 - np.searchsorted(np.sort(score_p), cuts, "left") / len(score_p)
    top_u = 1 - np.searchsorted(np.sort(score_u), cuts, "left") / len(score_u)
    spare = np.sqrt(np.log(90 / 0.1) / 2) * (1 / np.sqrt(len(score_u)) + 1 / np.sqrt(len(score_p)))
    best = int(np.argmin((top_u + spare) / np.maximum(top_p, 1e-9)))
    return float(np.clip(top_u[best] / max(top_p[best], 1e-9), 0.05, 0.98))


def fit_network(positives: np.ndarray, unlabelled: np.ndarray, epochs: int = EPOCHS) -> Network:
    """Estimate the prior on one half of the rows with a classifier of the other half,
    then minimise the non-negative risk on all. Without positives or unlabelled rows the
    network says 0.5 to everything."""
    size = len(FEATURES)
    if not len(positives) or not len(unlabelled):
        return Network(np.zeros(size), np.ones(size), (np.zeros((size, 1)), np.zeros(1), np.zeros(1), np.zeros(1)), 0.5)
    mean, scale = unlabelled.mean(0), np.maximum(unlabelled.std(0), 1e-3)
    blank = Network(mean, scale, (), 0.5)
    p, u = blank._scaled(positives), blank._scaled(unlabelled)
    half = _train(p[::2], u[::2], None, max(1, epochs // 4))
    prior = estimate_prior(_forward(half, p[1::2] if len(p) > 1 else p)[1], _forward(half, u[1::2] if len(u) > 1 else u)[1])
    return Network(mean, scale, _train(p, u, prior, epochs), prior)


def fit(documents: DataFrame, positives: DataFrame, sample: int = SAMPLE) -> Network:
    """A network from ``documents`` (doc_id, text) that may be learned from, and the ids
    of trusted ones. At most ``sample`` ids of each kind are used."""
    def smallest(ids: DataFrame) -> DataFrame:
        ids = ids.where(F.col("doc_id").isNotNull()).select("doc_id").distinct()
        return ids.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)

    chosen = smallest(positives).withColumn("kind", F.lit(1)).unionByName(
        smallest(documents).withColumn("kind", F.lit(0)))
    # at most 2 * sample ids; of an id's rows the one with the least features counts
    found = _numbers(documents.select("doc_id", "text").join(F.broadcast(chosen), "doc_id"))
    found = found.groupBy("doc_id", "kind").agg(F.min("features").alias("features"))
    rows = found.toPandas().sort_values(["kind", "doc_id"])
    table = np.array(rows["features"].tolist(), np.float64).reshape(-1, len(FEATURES))
    kind = rows["kind"].to_numpy()
    return fit_network(table[kind == 1], table[kind == 0])


def score(documents: DataFrame, network: Network) -> DataFrame:
    """(doc_id, score, predicted) of every row. Null and empty texts are scored like any
    other, with all features 0; repeated rows alike. Other columns are not looked at."""
    shared = documents.sparkSession.sparkContext.broadcast(network)  # a few thousand numbers

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks.blocks(batches):
            chance = shared.value.score(features(blocks.raw(block)))
            yield pa.RecordBatch.from_arrays(
                [block.column("doc_id"), pa.array(chance), pa.array((chance >= 0.5).astype(np.int32))],
                ["doc_id", "score", "predicted"])

    kind = documents.schema["doc_id"].dataType.simpleString()
    return documents.select("doc_id", "text").mapInArrow(judge, f"doc_id {kind}, score DOUBLE, predicted INT")


def fold(doc_id: str, folds: int) -> Column:
    """Remainder of the crc32 of an id as text; a null id is in no fold but 0."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % folds, F.lit(0))
