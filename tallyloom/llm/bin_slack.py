"""Packing by minimum bin slack.

Every document becomes token ids and is cut into whole windows and one remainder.
Remainders are packed group by group: a window takes the longest piece left, and
subset-sum dynamic programming over bit sets finds which multiset of the remaining
lengths comes closest to its capacity; going back through the stored sets gives how
many pieces of each length. One solution serves as many windows as its counts allow.

Tokens are made once, in the scan; afterwards only one short row per piece travels.
Groups are blocks of a fixed number of pieces in a fixed order, so memory is bounded
and a lost task packs its groups again in the same way.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm import blocks
from tallyloom.llm.subwords import Subwords
from tallyloom.runtime import materialize

CAPACITY = 1024
END_ID = 0
GROUP_PIECES = 50_000

_PIECES = "start BIGINT, length BIGINT, ids_crc32 BIGINT, doc_tokens BIGINT"
_PLACED = "sequence_id BIGINT, offset BIGINT"


def best_fill(counts: np.ndarray, room: int) -> list[int]:
    """Lengths, with repetition, of the pieces whose sum comes closest to ``room``
    without passing it. ``counts[n]`` pieces of length n are there."""
    mask = (1 << (room + 1)) - 1
    reach, steps = 1, []
    for length in range(room, 0, -1):
        for _ in range(min(int(counts[length]), room // length)):
            new = reach | (reach << length & mask)
            if new == reach:
                break
            steps.append((length, reach))
            reach = new
            if reach >> room & 1:
                break
        if reach >> room & 1:
            break
    total, used = reach.bit_length() - 1, []
    for length, before in reversed(steps):
        if not before >> total & 1:  # only with this piece was the sum reached
            used.append(length)
            total -= length
    return used


def pack_lengths(lengths: np.ndarray, capacity: int = CAPACITY) -> tuple[np.ndarray, np.ndarray]:
    """(window, offset) of every piece; windows count from 0 without gaps."""
    order = np.argsort(lengths, kind="stable")
    counts = np.bincount(lengths, minlength=capacity + 1)
    first = np.concatenate(([0], np.cumsum(counts)[:-1]))
    window, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    at, longest = 0, capacity
    while True:
        while longest and not counts[longest]:
            longest -= 1
        if not longest:
            return window, offset
        counts[longest] -= 1
        used = [longest, *best_fill(counts, capacity - longest)]
        counts[longest] += 1
        need = np.bincount(used)
        times = int((counts[:len(need)][need > 0] // need[need > 0]).min())
        for _ in range(times):
            place = 0
            for length in used:
                piece = order[first[length]]
                first[length] += 1
                window[piece], offset[piece] = at, place
                place += length
            at += 1
        counts[:len(need)] -= need * times


def pieces(documents: DataFrame, subwords: Subwords, capacity: int = CAPACITY,
           end_id: int = END_ID) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens): whole windows of each document's
    ids with the end id, and what remains."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        end = np.uint32(end_id).tobytes()
        for block in blocks.blocks(batches):
            owner, rows = [], []
            for i, text in enumerate(blocks.raw(block)):
                ids = memoryview(subwords.id_bytes(text) + end)
                total = len(ids) // 4
                for start in range(0, total, capacity):
                    part = ids[4 * start:4 * (start + capacity)]
                    owner.append(i)
                    rows.append((start, len(part) // 4, zlib.crc32(part), total))
            columns = np.array(rows, np.int64).reshape(-1, 4).T
            yield pa.RecordBatch.from_arrays(
                [block.column("doc_id").take(pa.array(owner, pa.int64())), *map(pa.array, columns)],
                ["doc_id", "start", "length", "ids_crc32", "doc_tokens"])

    kind = documents.schema["doc_id"].dataType.simpleString()
    return documents.select("doc_id", "text").mapInArrow(cut, f"doc_id {kind}, {_PIECES}")


def pack(documents: DataFrame, subwords: Subwords, capacity: int = CAPACITY, end_id: int = END_ID,
         group_pieces: int = GROUP_PIECES) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    A null text is packed like an empty one: its end id alone. Repeated rows are packed
    once each, rows without doc_id too. Offsets of a sequence have no gaps; sequence
    ids are unique, not dense. Other columns are not looked at.
    """
    cut = materialize(pieces(documents, subwords, capacity, end_id), "packing-pieces")
    groups = max(1, math.ceil(cut.where(F.col("length") < capacity).count() / group_pieces))
    names = cut.columns

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        following = TaskContext.get().partitionId() << 40
        held: list[pa.RecordBatch] = []

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal following
            if not held:
                return
            table = pa.Table.from_batches(held).combine_chunks()
            held.clear()
            window, offset = pack_lengths(table.column("length").to_numpy(), capacity)
            done = table.append_column("sequence_id", pa.array(window + following))
            following += int(window.max()) + 1
            yield from done.append_column("offset", pa.array(offset)).to_batches()

        for batch in batches:
            held.append(batch)
            if sum(b.num_rows for b in held) >= 2 * group_pieces:
                yield from flush()
        yield from flush()

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in cut.schema) + f", {_PLACED}"
    dealt = cut.repartition(groups, F.xxhash64(*names)).sortWithinPartitions(*names)
    return dealt.mapInArrow(place, schema)
