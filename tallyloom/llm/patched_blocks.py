"""Token ids in files of patched frame-of-reference blocks.

A shard file holds the ids of whole documents one after the other, in blocks of a fixed
number of ids. A block stores its minimum and the differences to it, packed at the width
that a given share of them needs; the others are exceptions, stored as place and whole
difference. Block starts, document starts and exception starts are indexed, so any span
of ids is read from the blocks that hold it.

Layout of a file, little-endian: ``HEADER``; ids of documents (int64), whether each has
one (uint8), starts of documents (uint64, one more than documents); minima (uint32) and
widths (uint8) of blocks, starts of blocks in words and of exceptions in their list
(uint64 each, one more than blocks); packed words (uint64); places (uint16) and
differences (uint32) of exceptions; crc32 of all before (uint32); a line end.

Documents are tokenised once, in the scan; their ids go straight to the range of their
document, whose limits come from one pass over the ids of documents alone. A task writes
its ranges as one shard after the other. Spark's own writer puts the files into place,
one row a file, so a lost task writes its shards again and a reader sees each once, in
any file system.
"""

from __future__ import annotations

import re
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyloom.llm import blocks
from tallyloom.runtime import materialize, scratch_dir

MAGIC = b"PFORIDS1"
HEADER = struct.Struct("<8sIIQQQQQQ")
BLOCK_IDS = 1024
PACKED_SHARE = 0.9
SHARD_IDS = 1 << 23
END_ID = 2
_LANES = 64  # one value of each lane goes into the same word, so blocks hold a multiple of it
RANGES_PER_TASK = 2
_ROWS = "range BIGINT, doc_id BIGINT, row BIGINT, n_tokens BIGINT, ids BINARY"


# -- blocks ------------------------------------------------------------------------

def _bits(values: np.ndarray) -> np.ndarray:
    """Bits that each value needs."""
    return np.frexp(values.astype(np.float64))[1].astype(np.uint8)


def pack(values: np.ndarray, width: int) -> np.ndarray:
    """Rows of values below 2**width as rows of words: 64 values make ``width`` words."""
    lanes = np.ascontiguousarray(values.reshape(-1, _LANES).T.astype(np.uint64))
    words = np.zeros((width, lanes.shape[1]), np.uint64)
    for lane in range(_LANES):
        word, shift = divmod(lane * width, 64)
        if width:
            words[word] |= lanes[lane] << np.uint64(shift)
        if shift + width > 64:
            words[word + 1] |= lanes[lane] >> np.uint64(64 - shift)
    return np.ascontiguousarray(words.T).reshape(len(values), -1)


def unpack(words: np.ndarray, width: int, size: int) -> np.ndarray:
    """The values again, ``size`` a row."""
    count = len(words) * (size // _LANES)
    lanes = np.zeros((_LANES, count), np.uint64)
    if width:
        given = np.ascontiguousarray(words.reshape(count, width).T)
        mask = np.uint64((1 << width) - 1)
        for lane in range(_LANES):
            word, shift = divmod(lane * width, 64)
            value = given[word] >> np.uint64(shift)
            if shift + width > 64:
                value |= given[word + 1] << np.uint64(64 - shift)
            lanes[lane] = value & mask
    return np.ascontiguousarray(lanes.T).reshape(len(words), size)


@dataclass
class Encoded:
    """Blocks of one shard: see the layout of a file."""

    minima: np.ndarray
    widths: np.ndarray
    block_starts: np.ndarray
    exception_starts: np.ndarray
    words: np.ndarray
    places: np.ndarray
    differences: np.ndarray


def encode(ids: np.ndarray, size: int = BLOCK_IDS, share: float = PACKED_SHARE) -> Encoded:
    """Blocks of ``size`` ids; the last one is filled up with its minimum."""
    count = -(-len(ids) // size)
    table = np.zeros((count, size), np.uint32)
    table.ravel()[:len(ids)] = ids
    if len(ids) % size:
        table[-1, len(ids) % size:] = ids[(count - 1) * size:].min()
    minima = table.min(axis=1) if count else np.zeros(0, np.uint32)
    table -= minima[:, None]
    nth = min(size - 1, int(np.ceil(share * size)) - 1)
    widths = _bits(np.partition(table, nth, axis=1)[:, nth]) if count else np.zeros(0, np.uint8)
    out = table >= (np.uint64(1) << widths.astype(np.uint64))[:, None]
    where, place = np.nonzero(out)
    differences = table[where, place]
    table[where, place] = 0
    block_starts = np.concatenate(([0], np.cumsum(widths.astype(np.int64) * (size // _LANES))))
    words = np.zeros(int(block_starts[-1]), np.uint64)
    for width in np.unique(widths):
        rows = np.flatnonzero(widths == width)
        span = np.arange(int(width) * (size // _LANES))
        words[block_starts[rows][:, None] + span] = pack(table[rows], int(width))
    exceptions = np.concatenate(([0], np.cumsum(np.bincount(where, minlength=count))))
    return Encoded(minima, widths, block_starts, exceptions, words, place.astype(np.uint16), differences)


def decode(found: Encoded, size: int, first: int = 0, last: int | None = None) -> np.ndarray:
    """Ids of the blocks from ``first`` up to ``last``."""
    last = len(found.minima) if last is None else last
    widths = found.widths[first:last]
    table = np.zeros((last - first, size), np.uint32)
    for width in np.unique(widths):
        rows = np.flatnonzero(widths == width)
        span = np.arange(int(width) * (size // _LANES))
        table[rows] = unpack(found.words[found.block_starts[first + rows][:, None] + span], int(width), size)
    begin, end = int(found.exception_starts[first]), int(found.exception_starts[last])
    where = np.repeat(np.arange(last - first), np.diff(found.exception_starts[first:last + 1]))
    table[where, found.places[begin:end]] = found.differences[begin:end]
    table += found.minima[first:last, None]
    return table.ravel()


# -- files -------------------------------------------------------------------------

def shard_bytes(part: int, number: int, doc_ids: list, starts: np.ndarray, ids: np.ndarray,
                size: int = BLOCK_IDS, share: float = PACKED_SHARE) -> bytes:
    """One file: shard ``number`` of the range ``part``."""
    if size % _LANES or not 0 < size <= 1 << 16:
        raise ValueError("blocks hold a multiple of 64 ids, 65536 at most")
    e = encode(ids, size, share)
    header = HEADER.pack(MAGIC, part, number, size, len(ids), len(doc_ids), len(e.minima), len(e.words), len(e.places))
    sections = [
        np.array([0 if i is None else i for i in doc_ids], "<i8"), np.array([i is not None for i in doc_ids], "u1"),
        starts.astype("<u8"), e.minima.astype("<u4"), e.widths, e.block_starts.astype("<u8"),
        e.exception_starts.astype("<u8"), e.words.astype("<u8"), e.places.astype("<u2"), e.differences.astype("<u4"),
    ]
    body = b"".join([header, *[s.tobytes() for s in sections]])
    return body + struct.pack("<I", zlib.crc32(body)) + b"\n"


class Shard:
    """A file read back. Only views are made until ids are asked for."""

    def __init__(self, content: bytes):
        magic, self.part, self.number, self.size, self.n_ids, docs, count, words, exceptions = HEADER.unpack_from(content)
        if magic != MAGIC:
            raise ValueError("not a file of patched blocks")
        at = HEADER.size

        def take(kind: str, n: int) -> np.ndarray:
            nonlocal at
            view = np.frombuffer(content, kind, n, at)
            at += view.nbytes
            return view

        self.doc_ids, self.has_id, self.starts = take("<i8", docs), take("u1", docs).astype(bool), take("<u8", docs + 1).astype(np.int64)
        self.blocks = Encoded(
            take("<u4", count), take("u1", count), take("<u8", count + 1).astype(np.int64),
            take("<u8", count + 1).astype(np.int64), take("<u8", words), take("<u2", exceptions), take("<u4", exceptions))
        if content[at:] != struct.pack("<I", zlib.crc32(memoryview(content)[:at])) + b"\n":
            raise ValueError(f"shard {self.part}/{self.number} is damaged")

    def read(self, start: int, stop: int) -> np.ndarray:
        """Ids from ``start`` up to ``stop``, out of the blocks that hold them."""
        first, last = start // self.size, -(-stop // self.size)
        if stop <= start:
            return np.zeros(0, np.uint32)
        return decode(self.blocks, self.size, first, last)[start - first * self.size:stop - first * self.size]


# -- tokens ------------------------------------------------------------------------

_tokenizers: dict[str, "Words"] = {}
#: Words that a worker remembers, the first it meets; others are encoded each time.
REMEMBERED = 500_000
#: Bytes of text whose distinct words are looked up at once.
LOOKED_UP = 1 << 22
_JOINED = 500


class Words:
    """Ids of words and texts from one tokenizer file, four bytes each.

    For a vocabulary that drops white space and joins nothing across it, texts are cut at
    spaces and line ends and each distinct word of a call is looked up once
    and encoded unless it is remembered. New words are encoded
    many at a time with ``MARK``, a word of one id, between them. Texts that hold the
    opening of a special token are encoded whole, and so is every text if the vocabulary
    is of another kind.
    """

    MARK = "0"
    #: Letters that neither case nor composition turns into anything else, and what may follow them.
    _PLAIN = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-/:-@\[-`{-~]*)")

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.known: dict[str, bytes] = {}
        mark = self._ids(self.MARK)
        self.mark = int(mark[0])
        probe = self._ids(f" x,{self.MARK} {self.MARK}  x\n{self.MARK}y").tolist()
        parts = [self._ids(w).tolist() for w in (f"x,{self.MARK}", self.MARK, "x", f"{self.MARK}y")]
        self.by_word = len(mark) == 1 and probe == sum(parts, [])
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)  # ids that end a word
        self.ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True

    def _ids(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")

    def _letters(self, words: list[str]) -> dict[str, bytes]:
        """Words of letters alone: each has one id that ends it, so none is needed between them."""
        found = {}
        for at in range(0, len(words), _JOINED):
            part = words[at:at + _JOINED]
            ids = self._ids(" ".join(part))
            cuts = ((np.flatnonzero(self.ends[ids]) + 1) * 4).tolist()
            if len(cuts) != len(part):
                return {w: self._ids(w).tobytes() for w in words}
            given = ids.tobytes()
            found.update(zip(part, [given[a:b] for a, b in zip([0, *cuts], cuts)]))
        return found

    def _encode(self, words: list[str]) -> dict[str, bytes]:
        """Ids of new words. Letters and the signs behind them are always apart."""
        split = {w: m.groups() for w in words if (m := self._PLAIN.fullmatch(w))} if self.ends.any() else {}
        known = self.known
        apart = {part for pair in split.values() for part in pair if part and part not in known}
        letters = [w for w in apart if w[-1].isalpha()]
        others = [w for w in words if w not in split] + [w for w in apart if not w[-1].isalpha()]
        found = self._letters(letters)
        found.update({w: self._ids(w).tobytes() for w in others if self.MARK in w})
        plain = [w for w in others if self.MARK not in w]
        for at in range(0, len(plain), _JOINED):
            part = plain[at:at + _JOINED]
            ids = self._ids(f" {self.MARK} ".join(part))
            cuts = np.flatnonzero(ids == self.mark) * 4
            given, begins = ids.tobytes(), [0, *(cuts + 4).tolist()]
            found.update(zip(part, [given[a:b] for a, b in zip(begins, [*cuts.tolist(), len(given)], strict=True)], strict=True))
        for word, (first, rest) in split.items():
            if rest:
                found[word] = (found.get(first) or known[first]) + (found.get(rest) or known[rest])
        return found

    def _known_ids(self, words: list[str]) -> list[bytes]:
        """Ids of distinct words; new ones are remembered while there is room."""
        known = self.known
        fresh = self._encode([w for w in words if w not in known])
        found = [ids if (ids := known.get(w)) is not None else fresh[w] for w in words]
        room = REMEMBERED - len(known)
        if room > 0:
            known.update(islice(((w, ids) for w, ids in fresh.items() if len(w) < 64), room))
        return found

    def _cut_ids(self, texts: list[bytes]) -> list[bytes]:
        """Ids of texts cut at spaces and line ends: words are numbered by Arrow, so each
        distinct one is looked up once, and numpy puts their ids in place."""
        data = b" ".join([*texts, b""]).replace(b"\n", b" ")
        ends = np.flatnonzero(np.frombuffer(data, np.uint8) == ord(" ")) + 1
        offsets = np.concatenate(([0], ends))
        words = pa.Array.from_buffers(  # each with the space behind it
            pa.large_binary(), len(ends), [None, pa.py_buffer(offsets), pa.py_buffer(data)]).dictionary_encode()
        place = words.indices.to_numpy()
        given = self._known_ids(pc.binary_slice(words.dictionary, 0, -1).cast(pa.large_string()).to_pylist())
        sizes = np.fromiter(map(len, given), np.int64, len(given)) >> 2
        per_word, after = sizes[place], np.zeros(len(ends) + 1, np.int64)
        np.cumsum(per_word, out=after[1:])
        steps = (np.cumsum(sizes) - sizes)[place] - after[:-1]
        ids = np.frombuffer(b"".join(given), "<u4")[np.repeat(steps, per_word) + np.arange(after[-1])]
        last = np.searchsorted(ends, np.cumsum([len(t) + 1 for t in texts]), "right")  # words up to each text's end
        cuts = after[[0, *last.tolist()]].tolist()
        return [ids[a:b].tobytes() for a, b in zip(cuts, cuts[1:])]

    def id_bytes(self, texts: list[str]) -> list[bytes]:
        """Ids of each text."""
        cut = [self.by_word and "<|" not in t for t in texts]
        found = iter(self._cut_ids([t.encode() for t, by_word in zip(texts, cut) if by_word]) if any(cut) else [])
        return [next(found) if by_word else self._ids(t).tobytes() for t, by_word in zip(texts, cut)]


def words_of(path: str) -> Words:
    """The tokenizer of a file in this worker."""
    if path not in _tokenizers:
        _tokenizers[path] = Words(path)
    return _tokenizers[path]


def limits(documents: DataFrame, ranges: int) -> tuple[int, np.ndarray]:
    """(ranges for rows without an id, limits of the others' ranges): quantiles of the
    ids, from one pass over that column. An id with many rows is many limits."""
    shares = [i / ranges for i in range(1, ranges)] or [0.5]
    found = documents.select(F.col("doc_id").cast("bigint").alias("doc_id")).agg(
        F.count(F.lit(1)).alias("n"), F.count("doc_id").alias("known"),
        F.percentile_approx("doc_id", shares, max(10_000, 4 * ranges)).alias("limits")).first()
    unknown = found["n"] - found["known"]
    return -(-unknown * ranges // max(found["n"], 1)), np.array(found["limits"] or [], np.int64)


def range_of(doc_ids: np.ndarray, known: np.ndarray, rows: np.ndarray, unknown_ranges: int,
             bounds: np.ndarray) -> np.ndarray:
    """Range of each row. A row whose id is a limit may lie on either side of it, so rows of
    one id are dealt by ``rows`` over all ranges that it can be in."""
    low, high = np.searchsorted(bounds, doc_ids, "left"), np.searchsorted(bounds, doc_ids, "right")
    return np.where(known, unknown_ranges + low + rows % (high - low + 1), rows % max(unknown_ranges, 1))


def tokens(documents: DataFrame, tokenizer_path: str, end_id: int = END_ID, ranges: int = 1) -> DataFrame:
    """(range, doc_id, row, n_tokens, ids): one row per document, its ids and the end id,
    two bytes each where all ids of the document fit, else four. ``row`` is its place in
    its part of the table, so give a stored table: a task that runs again then numbers
    its rows in the same way."""
    unknown_ranges, bounds = limits(documents, ranges)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        end, row = np.uint32(end_id).tobytes(), TaskContext.get().partitionId() << 40
        for block in blocks.blocks(batches, limit=LOOKED_UP):
            texts = [t or "" for t in block.column("text").to_pylist()]
            counts, packed = [], []
            for given in words_of(tokenizer_path).id_bytes(texts):
                ids = np.frombuffer(given + end, "<u4")
                counts.append(len(ids))
                packed.append((ids.astype("<u2") if ids.max() < 1 << 16 else ids).tobytes())
            rows = np.arange(row, row + len(texts))
            row += len(texts)
            doc_ids = block.column("doc_id").cast(pa.int64())
            known = doc_ids.is_valid().to_numpy(zero_copy_only=False)
            numbers = doc_ids.fill_null(0).to_numpy()
            yield pa.RecordBatch.from_arrays(
                [pa.array(range_of(numbers, known, rows, unknown_ranges, bounds)), doc_ids, pa.array(rows),
                 pa.array(counts, pa.int64()), pa.array(packed, pa.binary())],
                ["range", "doc_id", "row", "n_tokens", "ids"])

    return documents.select("doc_id", "text").mapInArrow(run, _ROWS)


def write_shards(documents: DataFrame, path: str, tokenizer_path: str, end_id: int = END_ID,
                 shard_ids: int = SHARD_IDS, block_ids: int = BLOCK_IDS, share: float = PACKED_SHARE) -> None:
    """Write the documents' ids as shard files below ``path``, in ascending order of id.

    Files are ordered by the range and number in their headers. Rows without an id come
    first; rows with the same id stand next to each other, and however many there are,
    they are dealt over several ranges. A null text is its end id alone. A shard is full
    with the document that brings it to ``shard_ids`` ids, so a task holds one shard, or
    one document if that is longer. No rows: no files.
    """
    parts = int(documents.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = tokens(documents, tokenizer_path, end_id, RANGES_PER_TASK * parts).repartition(parts, "range")
    ordered = dealt.sortWithinPartitions("range", "doc_id", "row")

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, total, held, doc_ids, lengths = None, 0, 0, [], [], []
        _tokenizers.clear()  # the worker may hold words of the stage before

        def close() -> pa.RecordBatch:
            starts = np.concatenate(([0], np.cumsum(lengths)))
            content = shard_bytes(part, number, doc_ids, starts, np.concatenate(held), block_ids, share)
            return pa.RecordBatch.from_arrays([pa.array([content], pa.binary())], ["content"])

        for batch in batches:
            for place, doc_id, n, given in zip(*(batch.column(c).to_pylist() for c in ("range", "doc_id", "n_tokens", "ids"))):
                if doc_ids and (place != part or total >= shard_ids):
                    yield close()
                    number = number + 1 if place == part else 0
                    total, held, doc_ids, lengths = 0, [], [], []
                part = place
                held.append(np.frombuffer(given, "<u2" if len(given) == 2 * n else "<u4"))
                doc_ids.append(doc_id)
                lengths.append(n)
                total += n
        if doc_ids:
            yield close()

    files = ordered.select("range", "doc_id", "n_tokens", "ids").mapInArrow(shards, "content BINARY")
    # the writer of lines puts the bytes as they are and the line end that closes each file
    files.select(F.expr("substring(content, 1, length(content) - 1)").cast("string").alias("value")) \
        .write.option("maxRecordsPerFile", 1).option("lineSep", "\n").text(path)


def read_shards(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document in the files below ``path``:
    how many ids all documents before it have, and its own ids' number and crc32."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column("content").to_pylist():
                if not content:
                    continue
                shard = Shard(content)
                ids = shard.read(0, shard.n_ids).astype("<u4", copy=False)
                given = memoryview(ids.view(np.uint8))
                bounds = (shard.starts * 4).tolist()
                crcs = [zlib.crc32(given[a:b]) for a, b in zip(bounds, bounds[1:])]
                n = len(crcs)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(n, shard.part)), pa.array(np.full(n, shard.number)),
                     pa.array(shard.doc_ids, mask=~shard.has_id), pa.array(shard.starts[:-1]),
                     pa.array(np.diff(shard.starts)), pa.array(crcs, pa.int64())],
                    ["part", "number", "doc_id", "inside", "n_tokens", "ids_crc32"])

    files = spark.read.format("binaryFile").load(path).where("length > 0").select("content")
    found = files.mapInArrow(
        run, "part BIGINT, number BIGINT, doc_id BIGINT, inside BIGINT, n_tokens BIGINT, ids_crc32 BIGINT")
    found = materialize(found, "read-back")
    # one row per file: what all files before it hold
    files_before = Window.orderBy("part", "number").rowsBetween(Window.unboundedPreceding, -1)
    sizes = found.groupBy("part", "number").agg(F.sum("n_tokens").alias("_ids"))
    offsets = sizes.select("part", "number", F.coalesce(F.sum("_ids").over(files_before), F.lit(0)).alias("_before"))
    return found.join(offsets, ["part", "number"]).select(
        "doc_id", (F.col("_before") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32")


def token_files(documents: DataFrame, tokenizer_path: str, end_id: int = END_ID, path: str | None = None,
                **options) -> DataFrame:
    """Write the files (below the scratch folder if no path is given) and read them back.

    Columns: doc_id, start, n_tokens, ids_crc32. Repeated rows have a row each.
    """
    spark = documents.sparkSession
    path = path or f"{scratch_dir(spark)}/token-files-{uuid.uuid4().hex}"
    write_shards(documents, path, tokenizer_path, end_id, **options)
    return read_shards(spark, path)
