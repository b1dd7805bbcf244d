"""Benchmark decontamination with suffix arrays of the training text.

Every task turns its block of documents into word ids of the benchmark's vocabulary
and sorts the suffixes that can begin a match: that is one shard of the training
suffix array. Every suffix of every benchmark item is then searched in it by binary
search; the range it meets gives all verbatim occurrences with their places, and
occurrences that follow each other make up the longest matches.

The benchmark is the query set: it is read in blocks of bounded size, each block
against all documents, and what the blocks find is put together per document.
"""

from __future__ import annotations

import hashlib
import math
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm import blocks
from tallyloom.runtime import materialize

WINDOW = 13
BENCHMARK_BLOCK_BYTES = 8 << 20
DOC_BLOCK_BYTES = 1 << 22
#: A document is contaminated if hit words are at least one in so many words.
SHARE = 20

#: Letters A-Z become a-z; every other ASCII character but a-z and 0-9 ends a word.
_WORDS = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b > 127 else 32 for b in range(256)
)
_ID_BYTES = 3
_MATCHES = "n_words BIGINT, spans ARRAY<STRUCT<start: BIGINT, length: BIGINT>>, items ARRAY<STRING>, longest BIGINT"


def words_of(text: bytes | None) -> list[bytes]:
    return text.translate(_WORDS).split() if text else []


@dataclass(frozen=True)
class Queries:
    """One block of the benchmark: its vocabulary and its distinct suffixes, cut to the
    window. ``items`` holds each distinct item once, with all ids that carry it."""

    vocabulary: dict[bytes, int]
    pairs: np.ndarray  # the first two ids of the suffixes, packed
    low: np.ndarray
    high: np.ndarray
    length: np.ndarray
    owners: list[list[int]]
    suffixes: list[list[int]]
    items: list[list[str]]
    shortest: int


def _packed(ids: np.ndarray, fill: int) -> bytes:
    """Ids of a suffix as bytes that sort like the ids, filled up to the window."""
    tail = bytes([fill]) * (_ID_BYTES * (WINDOW - len(ids)))
    return b"".join(int(i).to_bytes(_ID_BYTES, "big") for i in ids) + tail


def prepare(rows: list[tuple[str, bytes | None]]) -> Queries:
    """Suffixes of items given as (id, text). Items without words occur nowhere."""
    vocabulary: dict[bytes, int] = {}
    by_words: dict[tuple[int, ...], list[str]] = defaultdict(list)
    for item_id, text in rows:
        ids = tuple(vocabulary.setdefault(w, len(vocabulary) + 1) for w in words_of(text))
        if ids:
            by_words[ids].append(item_id)
    if len(vocabulary) >= 1 << (8 * _ID_BYTES):
        raise ValueError("a benchmark block has too many distinct words; lower its size")
    number: dict[tuple[int, ...], int] = {}
    owners: list[list[int]] = []
    suffixes: list[list[int]] = []
    for item, ids in enumerate(by_words):
        parts = [ids[i:i + WINDOW] for i in range(max(1, len(ids) - WINDOW + 1))]
        suffixes.append([])
        for part in parts:
            at = number.setdefault(part, len(number))
            if at == len(owners):
                owners.append([])
            if not owners[at] or owners[at][-1] != item:
                owners[at].append(item)
            suffixes[-1].append(at)
    known = list(number)
    width = _ID_BYTES * WINDOW
    return Queries(
        vocabulary,
        np.unique(np.array([p[0] << 24 | (p[1] if len(p) > 1 else 0) for p in known], np.int64)),
        np.array([_packed(p, 0) for p in known], f"S{width}"),
        np.array([_packed(p, 255) for p in known], f"S{width}"),
        np.array([len(p) for p in known], np.int64), owners, suffixes, list(by_words.values()),
        min(map(len, known), default=WINDOW),
    )


def suffix_array(ids: np.ndarray, queries: Queries) -> tuple[np.ndarray, np.ndarray]:
    """(places, keys) of the suffixes that begin like a benchmark suffix, sorted. ``ids``
    ends with a window of zeros; 0 stands for words outside the vocabulary."""
    n = len(ids) - WINDOW
    inside = np.concatenate((ids[:n] > 0, [False]))
    stops = np.flatnonzero(~inside)
    run = stops[np.searchsorted(stops, np.arange(n))] - np.arange(n)
    pair = ids[:n] << 24 | ids[1:n + 1]
    begins = np.isin(pair, queries.pairs)
    if queries.shortest == 1:
        begins |= np.isin(ids[:n] << 24, queries.pairs)
    places = np.flatnonzero(begins & (run >= queries.shortest))
    grid = ids[places[:, None] + np.arange(WINDOW)].astype(">u4")
    keys = np.ascontiguousarray(grid).view(np.uint8).reshape(-1, WINDOW, 4)[:, :, 1:]
    keys = np.ascontiguousarray(keys).reshape(-1, _ID_BYTES * WINDOW).view(f"S{_ID_BYTES * WINDOW}").ravel()
    order = np.argsort(keys, kind="stable")
    return places[order], keys[order]


def occurrences(ids: np.ndarray, queries: Queries) -> tuple[np.ndarray, np.ndarray]:
    """(place, suffix number) of every verbatim occurrence, found by binary search."""
    places, keys = suffix_array(ids, queries)
    first = np.searchsorted(keys, queries.low, "left")
    last = np.searchsorted(keys, queries.high, "right")
    found = np.repeat(np.arange(len(first)), last - first)
    inside = np.arange(len(found)) - np.repeat(np.cumsum(last - first) - (last - first), last - first)
    return places[first[found] + inside], found


def _longest(place: np.ndarray, suffix: np.ndarray, items: list[int], queries: Queries) -> int:
    """Words of the longest verbatim match of one document with one item."""
    best = 0
    for item in items:
        numbers = np.array(queries.suffixes[item])
        order = np.argsort(numbers, kind="stable")
        low = np.searchsorted(numbers[order], suffix, "left")
        high = np.searchsorted(numbers[order], suffix, "right")
        hit = np.repeat(np.arange(len(suffix)), high - low)
        if not len(hit):
            continue
        inside = np.arange(len(hit)) - np.repeat(np.cumsum(high - low) - (high - low), high - low)
        at, begin = order[low[hit] + inside], place[hit]
        sort = np.lexsort((begin, begin - at))
        follows = (np.diff(begin[sort]) == 1) & (np.diff((begin - at)[sort]) == 0)
        breaks = np.flatnonzero(np.concatenate(([True], ~follows, [True])))
        best = max(best, int(np.diff(breaks).max() - 1 + queries.length[numbers[0]]))
    return best


def _search(texts: list[bytes | None], queries: Queries) -> tuple[list, list, list, list]:
    get = queries.vocabulary.get
    ids, starts = [], [0]
    for text in texts:
        ids.extend([get(w, 0) for w in words_of(text)])
        starts.append(len(ids))
        ids.append(0)
    counts = [b - a - (i > 0) for i, (a, b) in enumerate(zip(starts, starts[1:]))]
    begin = [0, *(s + 1 for s in starts[1:-1])]
    spans: list = [[] for _ in texts]
    items: list = [[] for _ in texts]
    longest = [0] * len(texts)
    place, suffix = occurrences(np.array(ids + [0] * WINDOW, np.int64), queries)
    order = np.argsort(place, kind="stable")
    place, suffix = place[order], suffix[order]
    owner = np.searchsorted(starts[1:], place)
    cuts = np.flatnonzero(np.diff(owner)) + 1
    for p, s in zip(np.split(place, cuts), np.split(suffix, cuts)) if len(place) else ():
        doc = int(np.searchsorted(starts[1:], p[0]))
        end = np.maximum.accumulate(p + queries.length[s])
        breaks = np.flatnonzero(np.concatenate(([True], p[1:] > end[:-1])))
        ends = end[np.concatenate((breaks[1:], [len(p)])) - 1]
        spans[doc] = [{"start": int(a) - begin[doc], "length": int(b - a)} for a, b in zip(p[breaks], ends)]
        found = sorted({i for number in set(s.tolist()) for i in queries.owners[number]})
        items[doc] = [item_id for i in found for item_id in queries.items[i]]
        longest[doc] = _longest(p, s, found, queries)
    return counts, spans, items, longest


def search_block(documents: DataFrame, queries: Queries) -> DataFrame:
    """(doc_id, n_words, spans, items, longest) of every document, for one block."""
    shared = documents.sparkSession.sparkContext.broadcast(queries)  # a bounded block
    keys = [c for c in documents.columns if c != "text"]

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks.blocks(batches, limit=DOC_BLOCK_BYTES):
            counts, spans, items, longest = _search(blocks.raw(block), shared.value)
            span = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64())]))
            yield pa.RecordBatch.from_arrays(
                [*(block.column(k) for k in keys), pa.array(counts, pa.int64()), pa.array(spans, span),
                 pa.array(items, pa.list_(pa.string())), pa.array(longest, pa.int64())],
                [*keys, "n_words", "spans", "items", "longest"])

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in documents.schema
                          if f.name != "text"), _MATCHES])
    return documents.mapInArrow(search, schema)


def benchmark_blocks(benchmark: DataFrame, block_bytes: int = BENCHMARK_BLOCK_BYTES) -> Iterator[Queries]:
    """The benchmark in blocks of about ``block_bytes`` of text, one at a time."""
    items = benchmark.select(
        F.col("item_id").cast("string").alias("item_id"), F.col("text").cast("binary").alias("text"))
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(1, math.ceil(total / block_bytes))
    for part in range(parts):
        own = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == part).orderBy("item_id")
        yield prepare([(r.item_id, None if r.text is None else bytes(r.text)) for r in own.collect()])


def _covered(spans) -> int:
    """Words inside any of the spans."""
    total, end = 0, 0
    for start, length in sorted((s["start"], s["length"]) for s in spans):
        total += max(0, start + length - max(end, start))
        end = max(end, start + length)
    return total


def _sum_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = batch.to_pylist()
        hit = [_covered(r["spans"]) for r in rows]
        found = [set(r["items"]) for r in rows]
        items = [sorted(f - {None}, key=lambda i: i.encode()) for f in found]
        digests = [hashlib.sha256(",".join(i).encode()).hexdigest() for i in items]
        dirty = [h > 0 and SHARE * h >= r["n_words"] for h, r in zip(hit, rows)]
        keep = [c for c in batch.schema.names if c not in ("spans", "items", "longest")]
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(c) for c in keep), pa.array(hit, pa.int64()),
             pa.array([len(f) for f in found], pa.int64()), pa.array(digests, pa.string()),
             pa.array(dirty, pa.bool_()), batch.column("longest"), batch.column("spans")],
            [*keep, "n_hit", "n_items", "items_sha256", "contaminated", "longest", "spans"])


def _all_blocks(texts: DataFrame, benchmark: DataFrame, block_bytes: int) -> DataFrame:
    """What all blocks of the benchmark find, one row per row of ``texts``."""
    found = None
    for queries in benchmark_blocks(benchmark, block_bytes):
        if found is None:
            first, found = queries, []
            continue
        if not found:
            texts = materialize(texts.withColumn("_row", F.monotonically_increasing_id()), "decon-rows")
            found = [search_block(texts, first)]
        found.append(search_block(texts, queries))
    if not found:
        return search_block(texts, first)
    parts = found[0]
    for part in found[1:]:
        parts = parts.unionByName(part)
    others = [c for c in texts.columns if c not in ("text", "_row")]
    return parts.groupBy("_row").agg(  # one row per document and block
        *[F.first(c).alias(c) for c in others], F.max("n_words").alias("n_words"),
        F.flatten(F.collect_list("spans")).alias("spans"),
        F.flatten(F.collect_list("items")).alias("items"), F.max("longest").alias("longest")).drop("_row")


def contamination(documents: DataFrame, benchmark: DataFrame,
                  block_bytes: int = BENCHMARK_BLOCK_BYTES) -> DataFrame:
    """One row per row of ``documents``: doc_id, n_words, n_hit, n_items, items_sha256,
    contaminated, the longest verbatim match and the matched word spans.

    A null or empty text has no words and no hits. Items without words occur
    nowhere; items with the same words are all listed. Items without id count as one item
    and are not listed. Repeated document rows are
    judged each for itself. Other columns are not looked at.
    """
    merged = _all_blocks(documents.select("doc_id", "text"), benchmark, block_bytes)
    schema = (f"doc_id {documents.schema['doc_id'].dataType.simpleString()}, n_words BIGINT, n_hit BIGINT, "
              "n_items BIGINT, items_sha256 STRING, contaminated BOOLEAN, longest BIGINT, "
              "spans ARRAY<STRUCT<start: BIGINT, length: BIGINT>>")
    return merged.select("doc_id", "n_words", "spans", "items", "longest").mapInArrow(_sum_up, schema)


def decontaminate(documents: DataFrame, benchmark: DataFrame,
                  block_bytes: int = BENCHMARK_BLOCK_BYTES) -> DataFrame:
    """The rows of ``documents`` that are not contaminated, all columns unchanged. Rows
    are judged where they lie, so no text is shuffled."""
    names = documents.columns
    whole = documents.select(F.struct(*names).alias("_whole"), "text")
    judged = _all_blocks(whole, benchmark, block_bytes)
    hit = _merged_length("spans")
    dirty = (hit > 0) & (SHARE * hit >= F.col("n_words"))
    return judged.where(~dirty).select("_whole.*")


def _merged_length(spans: str):
    """Words inside any span of an array of (start, length) structs."""
    zero = F.struct(F.lit(0).cast("bigint").alias("total"), F.lit(0).cast("bigint").alias("end"))

    def add(state, span):
        end = span["start"] + span["length"]
        new = F.greatest(F.lit(0).cast("bigint"), end - F.greatest(state["end"], span["start"]))
        return F.struct((state["total"] + new).alias("total"), F.greatest(state["end"], end).alias("end"))

    return F.aggregate(F.array_sort(spans), zero, add)["total"]
