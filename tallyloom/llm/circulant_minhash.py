"""Near-duplicate documents with circulant MinHash, banding and exact verification.

Signatures come from two permutations only. The first spreads the shingles over the
universe; the second, read at circularly shifted places, gives all coordinates: for a
shingle at place ``x`` coordinate k is ``second[(x + k) mod D]``, so all coordinates of
a shingle lie side by side in memory.

1. Every document: set size, digest of its set, band keys. Equal sets form a class.
2. Classes that share a band are candidates. Links are confirmed on the full shingle
   sets, first of every class with one leader of each of its bands, a few times with
   other leaders, then, band by band, of all pairs that are not connected yet. Connected
   pairs need no further check, so a large group of near copies costs some checks per
   member and band, not one per pair, and no candidate is dropped.
   A pair is looked at only if its sizes and two bits of each coordinate allow the
   similarity: of pairs at the very limit, one in 100,000 differs in more coordinates.
3. Components of the confirmed links.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm import blocks
from tallyloom.llm.components import connected_components
from tallyloom.runtime import materialize

SHINGLE = 5
SIMILAR_PCT = 75
#: A pair at the limit of 0.75 misses all bands with a chance of 2 in 100,000.
BANDS, ROWS = 40, 5
#: Times that leaders are drawn before all pairs of different components are compared.
TURNS = 3
UNIVERSE = 1 << 20
#: Coordinates whose two lowest bits are kept, in words of 64. Two sets at the limit
#: differ in 192 of 1024 on average, with a standard deviation of 12.5.
SKETCHED = 1024
MAX_DIFFERENT = 246
_LOW = [f"low{i}" for i in range(SKETCHED // 64)]
_HIGH = [f"high{i}" for i in range(SKETCHED // 64)]
_WORDS = [*_LOW, *_HIGH]

_ODD = np.uint64(0xA24BAED4963EE407 | 1)
_second: dict[int, np.ndarray] = {}


def _shifted(coordinates: int) -> np.ndarray:
    """The second permutation read from every place: row x holds all coordinates of x."""
    if coordinates not in _second:
        order = np.random.default_rng(8).permutation(UNIVERSE).astype(np.int32)
        wrapped = np.concatenate((order, order[:coordinates - 1]))
        _second[coordinates] = np.lib.stride_tricks.sliding_window_view(wrapped, coordinates)
    return _second[coordinates]


def shingle_sets(texts: list[bytes | None]) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text: windows of five words, or the whole
    sequence of a text with fewer words."""
    words, bounds = blocks.word_hashes(texts, lower=True)
    windows = blocks.window_hashes(words, SHINGLE)
    sets = []
    for start, end in zip(bounds[:-1], bounds[1:]):
        n = end - start
        if n >= SHINGLE:
            sets.append(np.unique(windows[start:end - SHINGLE + 1]))
        elif n:
            short = words[start:end] * blocks.PLACES[SHINGLE + n:SHINGLE + 2 * n]
            sets.append(blocks.mix(short.sum(dtype=np.uint64, keepdims=True)))
        else:
            sets.append(np.zeros(0, np.uint64))
    return sets


def signature(shingles: np.ndarray, coordinates: int = SKETCHED) -> np.ndarray:
    """All MinHash coordinates of a set that is not empty."""
    first = (shingles * _ODD >> np.uint64(64 - UNIVERSE.bit_length() + 1)).astype(np.int64)
    table = _shifted(coordinates)
    parts = [table[first[i:i + 4096]].min(axis=0) for i in range(0, len(first), 4096)]
    return np.minimum.reduce(parts)


def band_keys(signatures: np.ndarray, bands: int = BANDS, rows: int = ROWS) -> np.ndarray:
    """One 64-bit key per band, different bands never mixed up by intent."""
    grid = signatures[:, :bands * rows].reshape(-1, bands, rows).astype(np.uint64) + np.uint64(1)
    key = (grid * blocks.PLACES[:rows]).sum(axis=2, dtype=np.uint64)
    return blocks.mix(key + np.arange(bands, dtype=np.uint64) * blocks.PLACES[63]).view(np.int64)


def sketch_words(signatures: np.ndarray) -> np.ndarray:
    """The two lowest bits of every coordinate: words of all last bits, then of all
    last but one."""
    bits = np.concatenate((signatures & 1, signatures >> 1 & 1), axis=1).astype(bool)
    return np.packbits(bits, axis=1).view(np.int64)


def _digest(shingles: np.ndarray) -> bytes:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for block in blocks.blocks(batches):
        sets = shingle_sets(blocks.raw(block))
        filled = [s for s in sets if len(s)]
        signatures = np.array([signature(s) for s in filled]).reshape(-1, SKETCHED)
        keys, bits = band_keys(signatures), np.zeros((len(sets), len(_WORDS)), np.int64)
        bits[[i for i, s in enumerate(sets) if len(s)]] = sketch_words(signatures)
        lengths = np.array([0, *(BANDS if len(s) else 0 for s in sets)], np.int32)
        yield pa.RecordBatch.from_arrays(
            [block.column("doc_id"), block.column("_key"), pa.array([len(s) for s in sets], pa.int64()),
             pa.array([_digest(s) if len(s) else None for s in sets], pa.binary()),
             pa.ListArray.from_arrays(pa.array(np.cumsum(lengths, dtype=np.int32)), pa.array(keys.ravel())), *map(pa.array, np.ascontiguousarray(bits.T))],
            ["doc_id", "_key", "n_shingles", "digest", "bands", *_WORDS])


def sketches(documents: DataFrame) -> DataFrame:
    """(doc_id, _key, n_shingles, digest, bands, low0, ..., high0, ...) of every row; digest is
    null without words. Rows that repeat a doc_id differ in ``_key`` if their texts do."""
    kind = documents.schema["doc_id"].dataType.simpleString()
    return documents.select("doc_id", "text", F.xxhash64("text").alias("_key")).mapInArrow(
        _sketch, f"doc_id {kind}, _key BIGINT, n_shingles BIGINT, digest BINARY, bands ARRAY<BIGINT>, "
                 + ", ".join(f"{w} BIGINT" for w in _WORDS))


def _sets(texts: DataFrame) -> DataFrame:
    """(node, shingles): the full set of each class. A text that is not the class's own,
    because its doc_id is repeated, is left out by comparing the digest again."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks.blocks(batches):
            sets = shingle_sets(blocks.raw(block))
            own = pa.array([len(s) > 0 and _digest(s) == d for s, d in
                            zip(sets, block.column("digest").to_pylist())], pa.bool_())
            filled = pa.array([s.tobytes() for s in sets], pa.binary())
            yield pa.RecordBatch.from_arrays(
                [block.column("node").filter(own), filled.filter(own)], ["node", "shingles"])

    return texts.select("node", "digest", "text").mapInArrow(build, "node BIGINT, shingles BINARY")


def _confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        linked = []
        left, right = batch.column("left_set").to_pylist(), batch.column("right_set").to_pylist()
        for a, b in zip(left, right):
            x, y = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
            both = np.sort(np.concatenate((x, y)))
            common = int((both[1:] == both[:-1]).sum())
            linked.append(100 * common >= SIMILAR_PCT * (len(x) + len(y) - common))
        keep = pa.array(linked, pa.bool_())
        yield pa.RecordBatch.from_arrays(
            [batch.column("a").filter(keep), batch.column("b").filter(keep)], ["a", "b"])


def confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) of classes whose full sets are similar enough."""
    left = sets.select(F.col("node").alias("a"), F.col("shingles").alias("left_set"))
    right = sets.select(F.col("node").alias("b"), F.col("shingles").alias("right_set"))
    return pairs.select("a", "b").join(left, "a").join(right, "b").mapInArrow(_confirm, "a BIGINT, b BIGINT")


def _ends(frame: DataFrame, end: str, columns: list[str]) -> DataFrame:
    """Columns renamed for one end of a pair."""
    return frame.select(*[F.col(c).alias(f"{c}_{end}") for c in columns])


def _possible():
    """Sizes and sketches of the ends a and b allow the similarity."""
    sizes = 100 * F.least("size_a", "size_b") >= SIMILAR_PCT * F.greatest("size_a", "size_b")
    xor = lambda w: F.col(f"{w}_a").bitwiseXOR(F.col(f"{w}_b"))
    different = sum((F.bit_count(xor(x).bitwiseOR(xor(y))) for x, y in zip(_LOW, _HIGH)), F.lit(0))
    return sizes & (different <= MAX_DIFFERENT)


def _star(led: DataFrame, classes: DataFrame, checked: DataFrame | None) -> DataFrame:
    """(a, b): every class with a leader of its bands that is in another component,
    where possible and not checked before."""
    pairs = led.where(F.col("root") != F.col("leader_root")).select(
        F.least("node", "leader").alias("node_a"), F.greatest("node", "leader").alias("node_b")).distinct()
    columns = ["node", "size", *_WORDS]
    pairs = pairs.join(_ends(classes, "a", columns), "node_a").join(
        _ends(classes, "b", columns), "node_b").where(_possible())
    pairs = pairs.select(F.col("node_a").alias("a"), F.col("node_b").alias("b"))
    if checked is not None:
        pairs = pairs.join(checked, ["a", "b"], "left_anti")
    return materialize(pairs, "minhash-star")


def _led(shared: DataFrame, roots: DataFrame | None, turn: int) -> DataFrame:
    """(band, node, root, leader, leader_root) of the bands that hold several components
    yet. The leader of a band is drawn by a hash of its classes and the turn."""
    rooted = shared.select("band", "node")
    if roots is None:
        rooted = rooted.withColumn("root", F.col("node"))
    else:
        rooted = rooted.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
        rooted = materialize(rooted.select("band", "node", "root"), "minhash-rooted")
    drawn = F.xxhash64("node", F.lit(turn))
    bands = rooted.groupBy("band").agg(
        F.min("root").alias("least"), F.max("root").alias("most"),
        F.min_by("node", drawn).alias("leader"), F.min_by("root", drawn).alias("leader_root"))
    mixed = bands.where(F.col("least") != F.col("most")).select("band", "leader", "leader_root")
    return materialize(rooted.join(mixed, "band"), "minhash-led")


def near_duplicates(documents: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept), one row per row of ``documents``.

    A null or empty text, or one of white space, has no shingles and is linked with
    nothing. A row without doc_id is linked with nothing either: its component is null
    and it is kept. Rows that repeat a doc_id are sketched each for itself; a component
    has the smallest doc_id of its rows. Other columns are not looked at.
    """
    return _judged(documents).drop("_key")


def _judged(documents: DataFrame) -> DataFrame:
    """``near_duplicates`` with the ``_key`` of each row."""
    sketched = materialize(sketches(documents), "minhash-sketches")
    usable = sketched.where(F.col("digest").isNotNull() & F.col("doc_id").isNotNull())
    # a class has the band keys of any of its rows: they are all the same
    classes = usable.groupBy("digest").agg(
        F.min("doc_id").alias("least"), F.first("n_shingles").alias("size"),
        *[F.first(c).alias(c) for c in ("bands", *_WORDS)])
    classes = materialize(classes.withColumn("node", F.monotonically_increasing_id()), "minhash-classes")

    led = _led(classes.select("node", F.explode("bands").alias("band")), None, 0)
    wanted = led.select("node").distinct()
    members = classes.join(wanted, "node").select(F.col("least").alias("doc_id"), "node", "digest")
    sets = materialize(_sets(documents.select("doc_id", "text").join(members, "doc_id")), "minhash-sets")
    sets = sets.groupBy("node").agg(F.first("shingles").alias("shingles"))  # a row may be repeated

    links, checked, roots = None, None, None
    for turn in range(1, TURNS + 1):
        star = _star(led, classes, checked)
        found = materialize(confirmed(star, sets), "minhash-links")
        if found.isEmpty():
            break
        checked = star if checked is None else checked.unionByName(star)
        links = found if links is None else links.unionByName(found)
        roots = connected_components(links)
        led = _led(led, roots, turn)

    columns = ["band", "bands", "node", "root", "size", *_WORDS]
    rest = led.select("band", "node", "root").join(classes.select("node", "bands", "size", *_WORDS), "node")
    rest = materialize(rest.select(*columns), "minhash-rest")
    unlinked = (F.col("node_a") < F.col("node_b")) & (F.col("root_a") != F.col("root_b"))
    once = F.array_min(F.array_intersect("bands_a", "bands_b")) == F.col("band_a")  # not in each band they share
    pairs = _ends(rest, "a", columns).join(_ends(rest, "b", columns), (F.col("band_a") == F.col("band_b")) & (
        unlinked & _possible() & once))
    pairs = pairs.select(F.col("node_a").alias("a"), F.col("node_b").alias("b"))
    if checked is not None:
        pairs = pairs.join(checked, ["a", "b"], "left_anti")
    more = materialize(confirmed(pairs, sets), "minhash-links")
    if not more.isEmpty():
        links = more if links is None else links.unionByName(more)
        roots = connected_components(links)
    if roots is None:
        roots = classes.select("node", F.col("node").alias("root"))

    labelled = classes.select("digest", "node", "least").join(roots, "node", "left").select(
        "digest", "least", F.coalesce("root", "node").alias("root"))
    least = labelled.groupBy("root").agg(F.min("least").alias("component_id"))
    component = labelled.join(least, "root").select("digest", "component_id")
    judged = sketched.select("doc_id", "_key", "n_shingles", "digest").join(component, "digest", "left")
    own = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return judged.select("doc_id", "_key", "n_shingles", own.alias("component_id")).withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def drop_near_duplicates(documents: DataFrame) -> DataFrame:
    """The rows that stand for their component, all columns unchanged. Of rows that repeat
    a doc_id only those go that are near copies themselves."""
    gone = _judged(documents).where(~F.col("kept")).select(
        F.col("doc_id").alias("_gone_id"), F.col("_key").alias("_gone_key")).distinct()
    return documents.join(
        gone, (documents["doc_id"] == F.col("_gone_id")) & (F.xxhash64(documents["text"]) == F.col("_gone_key")), "left_anti")
