"""Quality rules: fixed text rules, then a hashed n-gram log-likelihood ratio.

Two multinomials over hashed word unigrams and bigrams are counted on Spark: one of
the trusted target texts, one of the whole raw corpus. Every document gets the mean
log ratio of its n-grams, which is compared with one fixed threshold: the same text
gets the same verdict wherever it stands.

Counts of the raw corpus are counts of all its texts. What reaches the driver is one
number per bucket and corpus (``buckets``, fixed), whatever the size of the input.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.llm import blocks

SYMBOLS = b"#*$%&|<>"
REPEAT_WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PCT = 30
BUCKETS = 1 << 17
#: Pseudo-counts per bucket that pull the target towards the raw corpus.
PRIOR = 8.0
#: Mean log ratio per n-gram that a document must reach.
THRESHOLD = -0.08
_NOT_IN_WORDS = bytes([*blocks.WHITE, *range(0x80, 0xC0)])

_COUNTS = "bucket INT, n BIGINT"
_SCORES = ("n_words BIGINT, word_chars BIGINT, n_symbols BIGINT, n_dup_lines BIGINT, "
           "n_repeat_words BIGINT, base_failed BOOLEAN, llr DOUBLE, kept BOOLEAN")


def ngram_buckets(words: np.ndarray, bounds: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, text) of every unigram and bigram."""
    text, place = blocks.window_starts(bounds, 2)
    owner = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    pairs = blocks.window_hashes(words, 2)[place] if len(place) else np.zeros(0, np.uint64)
    shift = np.uint64(64 - int(buckets).bit_length() + 1)
    return (np.concatenate((words, pairs)) >> shift).astype(np.int64), np.concatenate((owner, text))


def bucket_counts(texts: DataFrame, buckets: int = BUCKETS, text: str = "text") -> DataFrame:
    """(bucket, n) over all texts. Each task adds up its own counts first."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for block in blocks.blocks(batches):
            words, bounds = blocks.word_hashes(blocks.raw(block))
            total += np.bincount(ngram_buckets(words, bounds, buckets)[0], minlength=buckets)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(seen, pa.int32()), pa.array(total[seen], pa.int64())], ["bucket", "n"])

    counted = texts.select(F.col(text).alias("text")).mapInArrow(count, _COUNTS)
    return counted.groupBy("bucket").agg(F.sum("n").alias("n"))


@dataclass(frozen=True)
class Ratios:
    """Log ratio of target to raw per bucket, and the verdict's threshold."""

    log_ratio: np.ndarray
    threshold: float = THRESHOLD


def fit(raw: DataFrame, target: DataFrame, buckets: int = BUCKETS, prior: float = PRIOR,
        threshold: float = THRESHOLD) -> Ratios:
    """Ratios of the texts of ``target`` to all texts of ``raw``. Without target texts
    every ratio is 0 and no document is rejected by it."""
    def table(texts: DataFrame) -> np.ndarray:
        counts = np.zeros(buckets)
        for row in bucket_counts(texts, buckets).collect():  # at most ``buckets`` rows
            counts[row.bucket] = row.n
        return counts

    base, trusted = table(raw), table(target)
    q = (base + 0.5) / (base.sum() + 0.5 * buckets)
    p = (trusted + prior * buckets * q) / (trusted.sum() + prior * buckets)
    return Ratios(np.log(p / q), threshold)


def repeated_words(words: np.ndarray, bounds: np.ndarray, size: int = REPEAT_WINDOW) -> np.ndarray:
    """Per text: words inside windows of ``size`` words that the text has twice or more."""
    text, place = blocks.window_starts(bounds, size)
    if not len(place):
        return np.zeros(len(bounds) - 1, np.int64)
    key = blocks.mix(blocks.window_hashes(words, size)[place] + blocks.mix(text.astype(np.uint64)))
    order = np.argsort(key, kind="stable")
    same = key[order][1:] == key[order][:-1]
    twice = np.zeros(len(key), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    change = np.zeros(len(words) + 1, np.int64)
    np.add.at(change, place[twice], 1)
    np.add.at(change, place[twice] + size, -1)
    return blocks.per_text(np.cumsum(change)[:-1] > 0, bounds)


def _line_facts(text: bytes | None) -> tuple[int, int, int]:
    """(word_chars, n_symbols, n_dup_lines)."""
    if not text:
        return 0, 0, 0
    lines = [line for line in text.split(b"\n") if line.strip(blocks.WHITE)]
    return (len(text.translate(None, _NOT_IN_WORDS)),
            len(text) - len(text.translate(None, SYMBOLS)), len(lines) - len(set(lines)))


def judge(documents: DataFrame, ratios: Ratios, text: str = "text") -> DataFrame:
    """All columns of ``documents`` followed by the rules' columns, one row for each row.

    Null and empty texts have no words and fail the base rules. Repeated rows are
    judged alike. ``llr`` is 0 for a text without words. A column of the input that has
    the name of a result column is replaced.
    """
    shared = documents.sparkSession.sparkContext.broadcast(ratios)  # one number per bucket
    names = [f.split()[0] for f in _SCORES.split(", ")]
    kept_names = [c for c in documents.columns if c not in names]
    # the input's columns travel as one struct, so that no name of theirs can clash
    source = documents.select(F.struct(*kept_names).alias("_whole"), F.col(text).alias("_text"))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ratio, threshold = shared.value.log_ratio, shared.value.threshold
        buckets = len(ratio)
        for block in blocks.blocks(batches, "_text"):
            texts = blocks.raw(block, "_text")
            words, bounds = blocks.word_hashes(texts)
            n_words = np.diff(bounds)
            repeat = repeated_words(words, bounds)
            facts = np.array([_line_facts(t) for t in texts], np.int64).reshape(-1, 3)
            bucket, owner = ngram_buckets(words, bounds, buckets)
            grams = np.bincount(owner, minlength=len(texts))
            llr = np.bincount(owner, ratio[bucket], minlength=len(texts)) / np.maximum(grams, 1)
            failed = (n_words < MIN_WORDS) | (100 * repeat > MAX_REPEAT_PCT * n_words)
            columns = [n_words, *facts.T, repeat, failed, llr, ~failed & (llr >= threshold)]
            yield pa.RecordBatch.from_arrays(
                [block.column("_whole"), *map(pa.array, columns)], ["_whole", *names])

    scored = source.mapInArrow(score, f"_whole {source.schema['_whole'].dataType.simpleString()}, {_SCORES}")
    return scored.select("_whole.*", *names)


def trusted_texts(documents: DataFrame, labels: DataFrame, trusted: Column | None = None) -> DataFrame:
    """Texts of the documents that ``labels`` trusts (quality 1). A document is taken
    once for each of its rows, however often its label is repeated.

    The ids grow with the table, so they are never broadcast: at every size both sides
    are sorted by id, each text travels once, and rows with one id for very many
    documents are split by Spark, since a semi join keeps their side whole.
    """
    good = labels.where(F.col("quality") == 1 if trusted is None else trusted)
    good = good.select("doc_id").where(F.col("doc_id").isNotNull()).distinct()
    known = documents.where(F.col("doc_id").isNotNull()).select("doc_id", "text")
    return known.join(good.hint("merge"), "doc_id", "left_semi").select("text")
