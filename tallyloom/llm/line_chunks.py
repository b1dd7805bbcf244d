"""Line dedup by content-defined chunks of lines.

Lines with words are hashed; a rolling hash over each line and the next decides where
a chunk begins, so the same passage is cut in the same way wherever it stands and
whatever was inserted before it. A line of more than ``LONG_LINE`` words is a chunk of
its own. Chunks of several lines, and those long lines, that occur more than once in
the corpus are removed everywhere but at their first place, after their bytes have
been compared.

Digests are counted first, and those with two places or more are marked in a sieve of
fixed size. A second pass sends the bytes of the chunks that pass it: they are compared by
grouping on the bytes themselves, combined in each task first, so a passage with a third
of all rows sends one row per task. A chunk that is alone sends its bytes only where the
sieve mistakes it. A digest that stands for several texts never removes anything.

Chunks miss passages whose ends lie inside them. So every line also begins, and ends,
a window: the fewest lines with more than ``LONG_LINE`` words. A repeated run of lines
with more words than that is the union of its windows, whatever stands around it.
Windows are grouped by two hashes over the hashes of their lines, and every line of those
that meet is compared by its bytes, once per block: windows overlap, their lines do not.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm import blocks
from tallyloom.llm.sieve import Sieve, marked, passing
from tallyloom.operators.lookup import salted_lookup, with_position
from tallyloom.runtime import materialize

#: One line in so many begins a chunk.
EVERY = 2
MIN_LINES = 2
LONG_LINE = 50
#: A chunk or window with a larger share of all repeated places is spread over tasks.
HEAVY = 0.001

_ROLL = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1


def chunk_places(lines: list[bytes], every: int = EVERY, min_lines: int = MIN_LINES,
                 long_line: int = LONG_LINE) -> list[list[int]]:
    """Places of the lines of every chunk that may be removed, chunk by chunk. Lines
    without words belong to no chunk."""
    worded = [i for i, line in enumerate(lines) if line.strip(blocks.WHITE)]
    hashes = [xxhash.xxh3_64_intdigest(lines[i]) for i in worded]
    long = [len(lines[i]) > 2 * long_line and len(lines[i].split()) > long_line for i in worded]
    chunks: list[list[int]] = []
    current: list[int] = []
    for k, place in enumerate(worded):
        after = hashes[k + 1] if k + 1 < len(worded) else 0
        rolled = (hashes[k] * _ROLL + after * (_ROLL >> 7 | 1)) & _MASK
        begins = (rolled >> 40) % every == 0
        if long[k]:
            chunks += [current, [place]]
            current = []
            continue
        if begins and len(current) >= min_lines:
            chunks.append(current)
            current = []
        current.append(place)
    chunks.append(current)
    is_long = {place for place, flag in zip(worded, long) if flag}
    return [c for c in chunks if len(c) >= min_lines or (c and c[0] in is_long)]


def _chunks(text: bytes | None) -> list[tuple[list[int], bytes]]:
    lines = (text or b"").split(b"\n")
    return [(places, b"\n".join([lines[i] for i in places])) for places in chunk_places(lines)]


def _digest(chunk: bytes) -> bytes:
    return hashlib.blake2b(chunk, digest_size=16).digest()


def chunk_rows(documents: DataFrame, with_bytes: bool) -> DataFrame:
    """(_row, doc_id, place, digest[, chunk]) of every chunk that may be removed."""
    names = ["_row", "doc_id", "place", "digest", *(["chunk"] if with_bytes else [])]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks.blocks(batches):
            owner, places, digests, chunks = [], [], [], []
            for i, text in enumerate(blocks.raw(block)):
                for at, chunk in _chunks(text):
                    owner.append(i)
                    places.append(at[0])
                    digests.append(_digest(chunk))
                    chunks.append(chunk)
            take = pa.array(owner, pa.int64())
            columns = [block.column("_row").take(take), block.column("doc_id").take(take),
                       pa.array(places, pa.int32()), pa.array(digests, pa.binary())]
            if with_bytes:
                columns.append(pa.array(chunks, pa.binary()))
            yield pa.RecordBatch.from_arrays(columns, names)

    kind = documents.schema["doc_id"].dataType.simpleString()
    schema = f"_row BIGINT, doc_id {kind}, place INT, digest BINARY" + ", chunk BINARY" * with_bytes
    return documents.select(_row(), "doc_id", "text").mapInArrow(cut, schema)


def _row():
    """Rows equal in id and text are one row to this operator."""
    return F.xxhash64("doc_id", "text").alias("_row")


def _place_id(*columns: str):
    return F.xxhash64(*columns)


def _repeated(rows: DataFrame, keys: list[str], place: list[str]) -> DataFrame:
    """The keys that stand at two different places or more: two numbers per key travel."""
    at = _place_id(*place)
    counted = rows.groupBy(*keys).agg(F.min(at).alias("_least"), F.max(at).alias("_most"))
    return counted.where(F.col("_least") != F.col("_most")).select(*keys)


def repeated_chunks(documents: DataFrame) -> DataFrame:
    """(digest, first place, n) of the chunks whose bytes occur at two places or more."""
    place = F.struct("doc_id", "_row", "place")
    known = marked(_repeated(chunk_rows(documents, False), ["digest"], ["doc_id", "_row", "place"]), F.xxhash64("digest"))
    # equal bytes meet here and nowhere else: this grouping is the comparison
    same = passing(chunk_rows(documents, True), known, F.xxhash64("digest")).groupBy("digest", "chunk").agg(
        F.min(place).alias("first"), F.max(place).alias("last"), F.count(F.lit(1)).alias("n"))
    same = same.where(~F.col("first").eqNullSafe(F.col("last"))).select("digest", "first", "n")
    return same.groupBy("digest").agg(
        F.min("first").alias("first"), F.max("n").alias("n"), F.count(F.lit(1)).alias("_texts")
    ).where(F.col("_texts") == 1).drop("_texts")


def _heavy(repeated: DataFrame, key: str) -> dict:
    """Keys with more than ``HEAVY`` of all repeated places, and parts to divide them into."""
    total = repeated.agg(F.sum("n")).first()[0] or 0
    found = repeated.where(F.col("n") > total * HEAVY).select(key, "n").collect()  # 1 / HEAVY rows at most
    return {row[0]: int(row["n"] / (total * HEAVY)) + 1 for row in found}


def removals(documents: DataFrame) -> DataFrame:
    """(_row, doc_id, places): first lines of the chunks to remove, per document."""
    repeated = materialize(repeated_chunks(documents).withColumn("digest", F.hex("digest")), "line-chunks")
    known = marked(repeated, F.xxhash64("digest"))
    places = chunk_rows(documents, False).withColumn("digest", F.hex("digest"))
    found = with_position(passing(places, known, F.xxhash64("digest")))
    found = salted_lookup(found, repeated.select(F.col("digest").alias("_digest"), "first"), "digest", "_digest",
                          _heavy(repeated, "digest"))
    at = F.struct("doc_id", "_row", "place")
    found = found.where(F.col("first").isNotNull() & ~at.eqNullSafe(F.col("first")))
    # at most one entry per chunk of the document
    return found.groupBy("_row", "doc_id").agg(F.collect_set("place").alias("_places"))


# -- windows of lines ------------------------------------------------------------

def line_windows(texts: list[bytes | None], words: int = LONG_LINE) -> tuple[np.ndarray, ...]:
    """(text, first line, last line, hash, check) of the windows of several texts: from
    each line on, and up to each line, the fewest lines with more than ``words`` words.
    Lines without words count nothing and are skipped."""
    owner, places, sizes, digests = [], [], [], []
    for i, text in enumerate(texts):
        for at, line in enumerate((text or b"").split(b"\n")):
            n = len(line.split())
            if n:
                owner.append(i)
                places.append(at)
                sizes.append(n)
                digests.append(xxhash.xxh3_128_digest(line))
    owner, places, sizes = (np.array(x, np.int64) for x in (owner, places, sizes))
    hashes, n = np.frombuffer(b"".join(digests), np.uint64).reshape(-1, 2), len(owner)
    if not n:
        return owner, owner, owner, owner, owner
    until = np.cumsum(sizes)
    before = until - sizes
    lines = np.arange(n)
    end = np.searchsorted(until, before + words + 1)
    begin = np.searchsorted(before, until - words - 1, side="right") - 1
    pairs = np.concatenate((np.stack((lines, end)), np.stack((begin, lines))), axis=1)
    pairs = pairs[:, (pairs[0] >= 0) & (pairs[1] < n)]
    pairs = pairs[:, owner[pairs[0]] == owner[pairs[1]]]
    first, last = np.divmod(np.unique(pairs[0] * n + pairs[1]), n)
    up, down = blocks._power(n + 1)
    found = []
    for value in (hashes[:, 0], blocks.mix(hashes[:, 1] ^ np.uint64(_ROLL))):
        total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(value * up[:-1], dtype=np.uint64)))
        found.append(blocks.mix((total[last + 1] - total[first]) * down[first]).view(np.int64))
    return owner[first], places[first], places[last], *found


_WINDOW = ["_row", "doc_id", "place", "stop", "hash", "check"]


def window_rows(documents: DataFrame, known: Sieve | None = None, bad: Sieve | None = None) -> DataFrame:
    """(_row, doc_id, place, stop, hash, check, line) of the windows, all of them or those
    that pass the sieve of ``known`` hashes. With a sieve there are also rows without place,
    one for each line of these windows in a block: its bytes as ``line`` and the two halves
    of its hash. Windows with a line in ``bad`` are left out."""
    kept, left_out = (None if s is None else s.shared(documents.sparkSession) for s in (known, bad))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks.blocks(batches):
            texts = blocks.raw(block)
            owner, place, stop, hashes, check = line_windows(texts)
            lines: dict[bytes, tuple[int, int]] = {}
            if kept is not None:
                hit = np.flatnonzero(kept.value.holds(hashes))
                windows = []
                for k, i, a, b in zip(hit.tolist(), owner[hit].tolist(), place[hit].tolist(), stop[hit].tolist()):
                    rows = texts[i].split(b"\n") if not windows or windows[-1][0] != i else rows  # noqa: F821
                    inside = [line for line in rows[a:b + 1] if line.strip(blocks.WHITE)]
                    for line in inside:
                        if line not in lines:
                            lines[line] = tuple(np.frombuffer(xxhash.xxh3_128_digest(line), np.int64).tolist())
                    sure = left_out is None or not left_out.value.holds(np.array([lines[x][0] for x in inside])).any()
                    windows.append((i, k, sure))
                hit = np.array([k for _, k, sure in windows if sure], np.int64)
                owner, place, stop, hashes, check = (x[hit] for x in (owner, place, stop, hashes, check))
            take, n, m = pa.array(owner), len(owner), len(lines)
            pairs = np.array(list(lines.values()), np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([
                pa.concat_arrays([block.column("_row").take(take), pa.nulls(m, pa.int64())]),
                pa.concat_arrays([block.column("doc_id").take(take), pa.nulls(m, block.column("doc_id").type)]),
                pa.concat_arrays([pa.array(place.astype(np.int32)), pa.nulls(m, pa.int32())]),
                pa.concat_arrays([pa.array(stop.astype(np.int32)), pa.nulls(m, pa.int32())]),
                pa.array(np.concatenate((hashes, pairs[:, 0]))), pa.array(np.concatenate((check, pairs[:, 1]))),
                pa.concat_arrays([pa.nulls(n, pa.binary()), pa.array(list(lines), pa.binary())]),
            ], [*_WINDOW, "line"])

    kind = documents.schema["doc_id"].dataType.simpleString()
    return documents.select(_row(), "doc_id", "text").mapInArrow(
        cut, f"_row BIGINT, doc_id {kind}, place INT, stop INT, hash BIGINT, check BIGINT, line BINARY")


def _mistaken_lines(found: DataFrame) -> DataFrame:
    """Hashes that stand for several lines."""
    # equal bytes meet here: this grouping is the comparison
    same = found.where(F.col("line").isNotNull()).groupBy("hash", "check", "line").agg(F.lit(1).alias("_one"))
    return same.groupBy("hash", "check").agg(F.count(F.lit(1)).alias("_texts")).where(F.col("_texts") > 1)


def repeated_windows(documents: DataFrame) -> DataFrame:
    """Stored places of the windows that may occur at two places or more, none of which
    has a line whose hash stands for other bytes too."""
    place = ["doc_id", "_row", "place", "stop"]
    known = Sieve.of(_repeated(window_rows(documents), ["hash", "check"], place), F.col("hash"))
    found = materialize(window_rows(documents, known), "line-windows")
    mistaken = _mistaken_lines(found)
    if not mistaken.isEmpty():  # then all windows with a line of that mark are set aside
        found = materialize(window_rows(documents, known, Sieve.of(mistaken, F.col("hash"))), "line-windows")
    return found.where(F.col("line").isNull()).drop("line")


def window_removals(documents: DataFrame) -> DataFrame:
    """(_row, doc_id, spans): first and last lines to remove of each document, since they
    stand earlier in a repeated window. A window that overlaps its own first place gives
    up only what lies behind that."""
    rows = repeated_windows(documents).withColumn("key", F.concat_ws(":", "hash", "check"))
    place = F.struct("doc_id", "_row", "place", "stop")
    repeated = rows.groupBy("key").agg(
        F.min(place).alias("first"), F.max(place).alias("last"), F.count(F.lit(1)).alias("n"))
    repeated = materialize(repeated.where(~F.col("first").eqNullSafe(F.col("last"))).select(
        F.col("key").alias("_gone_key"), "first", "n"), "line-window-firsts")
    sure = salted_lookup(with_position(rows), repeated.drop("n"), "key", "_gone_key", _heavy(repeated, "_gone_key"))
    sure = sure.where(F.col("first").isNotNull())
    here = F.col("first.doc_id").eqNullSafe(F.col("doc_id")) & (F.col("first._row") == F.col("_row"))
    start = F.when(here, F.greatest("place", F.col("first.stop") + 1)).otherwise(F.col("place"))
    gone = sure.select("_row", "doc_id", start.alias("place"), "stop").where(F.col("place") <= F.col("stop"))
    return gone.groupBy("_row", "doc_id").agg(F.collect_set(F.struct("place", "stop")).alias("_spans"))


def dedup_passages(documents: DataFrame) -> DataFrame:
    """``dedup_lines``, and also without every run of lines of more than ``LONG_LINE``
    words that stands elsewhere first, whatever stands around it."""
    return dedup_lines(documents, True)


def dedup_lines(documents: DataFrame, passages: bool = False) -> DataFrame:
    """All columns of ``documents``, ``text`` without the chunks that stand elsewhere
    first, and n_removed_lines, n_removed_words, one row for each row.

    The first place of a chunk is the smallest (doc_id, line), a null doc_id before all
    others. Rows equal in id and text count as one place and get the same text; a chunk
    that only such rows share stays. Null texts stay null. Lines without words stay. A
    text all of whose lines go becomes empty, the row stays. Columns of the input named
    n_removed_lines or n_removed_words are replaced.
    """
    counts = ["n_removed_lines", "n_removed_words"]
    names = [c for c in documents.columns if c not in counts]
    others = [c for c in names if c != "text"]
    gone = removals(documents)
    if passages:
        spans = window_removals(documents).select("_row", "doc_id", F.lit(None).alias("_places"), "_spans")
        # one row of each kind for a document at most
        gone = gone.withColumn("_spans", F.lit(None)).unionByName(spans).groupBy("_row", "doc_id").agg(
            F.max("_places").alias("_places"), F.max("_spans").alias("_spans"))
    else:
        gone = gone.withColumn("_spans", F.lit(None).cast("array<struct<place:int,stop:int>>"))
    gone = gone.withColumnsRenamed({"_row": "_gone_row", "doc_id": "_gone_id"})
    # other columns travel as one struct, so that no name of theirs can clash
    whole = documents.select(F.struct(*others).alias("_whole"), "text", _row())
    own = (F.col("_row") == F.col("_gone_row")) & F.col("_whole.doc_id").eqNullSafe(F.col("_gone_id"))
    whole = whole.join(gone, own, "left").select("_whole", "text", "_places", "_spans")

    def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks.blocks(batches):
            texts, removed = [], []
            for text, starts, spans in zip(
                    blocks.raw(block), block.column("_places").to_pylist(), block.column("_spans").to_pylist()):
                if not starts and not spans:
                    texts.append(text)
                    removed.append((0, 0))
                    continue
                lines, starts = text.split(b"\n"), set(starts or ())
                drop = {i for at in chunk_places(lines) if at[0] in starts for i in at} if starts else set()
                spanned = {i for x in spans or () for i in range(x["place"], x["stop"] + 1)}
                drop.update(i for i in spanned if lines[i].strip(blocks.WHITE))
                texts.append(b"\n".join([line for i, line in enumerate(lines) if i not in drop]))
                removed.append((len(drop), sum(len(lines[i].split()) for i in drop)))
            yield pa.RecordBatch.from_arrays(
                [block.column("_whole"), pa.array(texts, pa.binary()).cast(pa.string()),
                 pa.array([r[0] for r in removed], pa.int64()), pa.array([r[1] for r in removed], pa.int64())],
                ["_whole", "text", *counts])

    kind = whole.schema["_whole"].dataType.simpleString()
    done = whole.mapInArrow(rewrite, f"_whole {kind}, text STRING, " + ", ".join(f"{c} BIGINT" for c in counts))
    return done.select(*[F.col(c if c == "text" else f"_whole.`{c}`").alias(c) for c in names], *counts)
