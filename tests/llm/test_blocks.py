import numpy as np
import pyarrow as pa
import pytest

from tallyloom.llm import blocks

TEXTS = [b"", None, b"one", b" two  words\t here\x0b\x0c\r\n", "é ü ñandú".encode(), b"a b a b " * 50, b"x" * 5000]


@pytest.mark.parametrize("lower", [False, True])
def test_words_are_hashed_alike_wherever_they_stand(lower, monkeypatch):
    for segment in (1 << 20, 7):
        monkeypatch.setattr(blocks, "SEGMENT", segment)
        hashes, bounds = blocks.word_hashes(TEXTS, lower)
        seen = {}
        for i, text in enumerate(TEXTS):
            words = (text or b"").split()
            own = hashes[bounds[i]:bounds[i + 1]]
            assert len(own) == len(words)
            for word, h in zip(words, own.tolist()):
                assert seen.setdefault(word, h) == h
        assert len(set(seen.values())) == len(seen)


def test_lower_case_is_ascii_only():
    a, _ = blocks.word_hashes(["ABC É".encode()], True)
    b, _ = blocks.word_hashes(["abc É".encode(), "abc é".encode()], True)
    assert a[0] == b[0] == b[2] and a[1] == b[1] != b[3]


def test_windows_stay_inside_a_text():
    words, bounds = blocks.word_hashes([b"a b c", b"", b"a b c d"])
    text, place = blocks.window_starts(bounds, 3)
    assert text.tolist() == [0, 2, 2] and place.tolist() == [0, 3, 4]
    hashes = blocks.window_hashes(words, 3)
    assert hashes[0] == hashes[3] != hashes[4]


def test_blocks_hold_every_row_once():
    batch = pa.RecordBatch.from_pydict({"id": list(range(7)), "text": ["a" * 10, None, "b" * 30, "", "c" * 5, "d", "e"]})
    parts = list(blocks.blocks([batch], limit=12))
    assert [i for p in parts for i in p.column("id").to_pylist()] == list(range(7))
    assert len(parts) == 2
    assert list(blocks.blocks([batch.slice(0, 0)])) == []


def test_per_text_counts():
    assert blocks.per_text(np.array([1, 0, 1, 1], bool), np.array([0, 2, 2, 4])).tolist() == [1, 0, 2]
