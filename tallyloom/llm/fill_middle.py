"""Fill-in-the-middle rows from whole texts.

A text is cut twice and its parts are written in another order, with a marker before
each part. Cuts are drawn from a hash of the id, in code points or in bytes. Texts stay
UTF-8 bytes throughout: an index of the multibyte characters alone (their places and
their bytes beyond one) turns code points into bytes and back by binary search, and
spans of ASCII need arithmetic only. The index of a block of texts is one array for all
of them, so all cuts of a block are converted at once.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.llm import blocks

_PARTS = "n BIGINT, form STRING, output STRING, prefix_chars BIGINT, middle_chars BIGINT"


@dataclass(frozen=True)
class Layout:
    """Markers of the three parts, and how often a text takes which form: of 100, the
    last ``plain`` stay as they are; of 100 others the first ``suffix_first`` begin with
    their suffix. ``salt`` goes before the id that is hashed. With ``unit`` "bytes" cuts
    are drawn over bytes and moved back to the beginning of a character."""

    prefix: str = "<P>"
    suffix: str = "<S>"
    middle: str = "<M>"
    plain: int = 10
    suffix_first: int = 20
    salt: str = "1:"
    unit: str = "chars"

    def __post_init__(self):
        markers = (self.prefix, self.suffix, self.middle)
        if len(set(markers)) < 3 or not all(markers):
            raise ValueError("three different markers are needed")
        for a in markers:  # then no marker begins inside another, and the first one found is the right one
            for b in markers:
                if a != b and b in a or any(a.endswith(b[:k]) for k in range(1, len(b))):
                    raise ValueError(f"marker {b!r} can begin within {a!r}")
        if self.unit not in ("chars", "bytes"):
            raise ValueError(f"unknown unit {self.unit!r}")


class Exceptions:
    """The multibyte characters of joined UTF-8 texts: first byte, place in code points,
    and how many bytes beyond one all before them take."""

    def __init__(self, data: np.ndarray):
        self.byte = np.flatnonzero(data >= 0xC0)
        lead = data[self.byte]
        excess = 1 + (lead >= 0xE0).astype(np.int64) + (lead >= 0xF0)
        self.before = np.concatenate(([0], np.cumsum(excess)))
        self.char = self.byte - self.before[:-1]

    def to_bytes(self, chars: np.ndarray) -> np.ndarray:
        """First bytes of the given code points."""
        return chars + self.before[np.searchsorted(self.char, chars)]

    def to_chars(self, places: np.ndarray) -> np.ndarray:
        """Code points that begin at the given bytes, or that the bytes lie in."""
        passed = np.searchsorted(self.byte, places)
        chars = places - self.before[passed]
        inside = np.zeros(len(places), bool)
        some = passed > 0
        last = passed[some] - 1
        inside[some] = places[some] < self.byte[last] + 1 + self.before[last + 1] - self.before[last]
        chars[some] = np.where(inside[some], self.char[last], chars[some])
        return chars


def draws(ids: list, salt: str) -> np.ndarray:
    """Four unsigned 32-bit numbers of each id; a null id is hashed as empty."""
    digests = [hashlib.sha256(f"{salt}{'' if i is None else i}".encode()).digest()[:16] for i in ids]
    return np.frombuffer(b"".join(digests), ">u4").reshape(-1, 4).astype(np.int64)


def rearrange(texts: list[bytes | None], ids: list, layout: Layout) -> dict[str, list]:
    """The rows of a block of texts, column by column."""
    texts = [t or b"" for t in texts]
    ends = np.cumsum([len(t) for t in texts], dtype=np.int64)
    starts = ends - np.fromiter(map(len, texts), np.int64, len(texts))
    index = Exceptions(np.frombuffer(b"".join(texts), np.uint8))
    first = index.to_chars(starts)
    n = index.to_chars(ends) - first
    drawn = draws(ids, layout.salt)
    span = n if layout.unit == "chars" else ends - starts
    cuts = np.sort(drawn[:, :2] % (span + 1)[:, None], axis=1)
    if layout.unit == "chars":
        chars = cuts
    else:
        chars = index.to_chars((starts[:, None] + cuts).ravel()).reshape(-1, 2) - first[:, None]
    at = index.to_bytes((first[:, None] + chars).ravel()).reshape(-1, 2) - starts[:, None]
    markers = [m.encode() for m in (layout.prefix, layout.suffix, layout.middle)]
    p, s, m = markers
    plain = (n == 0) | (drawn[:, 2] % 100 >= 100 - layout.plain)
    backward = drawn[:, 3] % 100 < layout.suffix_first
    forms, outputs = [], []
    for text, stays, turned, (a, b) in zip(texts, plain.tolist(), backward.tolist(), at.tolist()):
        if stays or any(marker in text for marker in markers):
            forms.append("plain")
            outputs.append(text)
        elif turned:
            forms.append("spm")
            outputs.append(b"".join((s, text[b:], p, text[:a], m, text[a:b])))
        else:
            forms.append("psm")
            outputs.append(b"".join((p, text[:a], s, text[b:], m, text[a:b])))
    kept = [form == "plain" for form in forms]
    return {
        "n": n.tolist(), "form": forms, "output": outputs,
        "prefix_chars": [None if k else c for k, c in zip(kept, chars[:, 0].tolist())],
        "middle_chars": [None if k else c for k, c in zip(kept, (chars[:, 1] - chars[:, 0]).tolist())],
    }


def fill_in_middle(documents: DataFrame, layout: Layout = Layout()) -> DataFrame:
    """(doc_id, n, form, output, prefix_chars, middle_chars) of each row.

    A null text counts as empty; an empty text and one that holds a marker stay plain.
    Repeated ids get the same draws, rows without an id those of an empty id. Other
    columns are not looked at. No row meets another, so nothing is shuffled, and a task
    holds one block of a few megabytes, or one text if that is longer.
    """

    def turn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64(), pa.string(), pa.binary(), pa.int64(), pa.int64()]
        for block in blocks.blocks(batches):
            found = rearrange(blocks.raw(block), block.column("doc_id").to_pylist(), layout)
            columns = [pa.array(values, kind) for values, kind in zip(found.values(), kinds)]
            columns[2] = columns[2].cast(pa.string())
            yield pa.RecordBatch.from_arrays([block.column("doc_id"), *columns], ["doc_id", *found])

    kind = documents.schema["doc_id"].dataType.simpleString()
    return documents.select("doc_id", "text").mapInArrow(turn, f"doc_id {kind}, {_PARTS}")


def restored(layout: Layout = Layout(), output: str = "output", form: str = "form") -> Column:
    """The text that an output was made of, by its markers alone."""
    out = F.col(output)

    def behind(marker: str) -> Column:
        return F.substring_index(out, marker, -1)

    def between(marker: str, following: str) -> Column:
        return F.substring_index(F.substring_index(out, following, 1), marker, -1)

    psm = F.concat(between(layout.prefix, layout.suffix), behind(layout.middle), between(layout.suffix, layout.middle))
    spm = F.concat(between(layout.prefix, layout.middle), behind(layout.middle), between(layout.suffix, layout.prefix))
    return F.when(F.col(form) == "psm", psm).when(F.col(form) == "spm", spm).otherwise(out)
