"""Token files, fill-in-the-middle and whitening against plain versions, with every odd case."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tallyloom.llm import fill_middle, patched_blocks, shifted_qr

public_tokenizers = pytest.importorskip("public_tokenizers")
TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
SCHEMA = "doc_id BIGINT, text STRING, row BIGINT, n BIGINT, form STRING, content STRING, output STRING"


def frame(spark, rows, parts=3):
    return spark.createDataFrame([(i, t, 1, 2, "f", "c", "o") for i, t in rows], SCHEMA).repartition(parts)


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(5)
    some = ["".join(rng.choice("ab é漢😀 \nxyz0'") for _ in range(rng.randrange(60))) for _ in range(60)]
    some += ["", None, " ", "<P>a", "a<S", "S>b<", "< M>", "x<M>", "0 0 0", "<|endoftext|> a", "a" * 30_000,
             "Wörter und Zahlen 10 203 " * 3000, "é" * 5000, "don't STOP\r\n\tnow here there\x1cend"]
    return [(3 * i, t) for i, t in enumerate(some)] + [(None, "no id"), (3, "again"), (3, "again"), (None, None), (-4, "minus")]


# -- token files -------------------------------------------------------------------

@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 300), st.integers(0, 2**32 - 1)), max_size=700),
       st.sampled_from([64, 128, 1024]), st.sampled_from([0.5, 0.9, 1.0]))
def test_blocks_give_all_ids_back(values, size, share):
    ids = np.array(values, np.uint32)
    content = patched_blocks.shard_bytes(3, 4, [7, None], np.array([0, len(ids) // 2, len(ids)]), ids, size, share)
    shard = patched_blocks.Shard(content)
    assert (shard.part, shard.number, shard.n_ids) == (3, 4, len(ids))
    assert shard.read(0, len(ids)).tolist() == values
    third = len(ids) // 3
    assert shard.read(third, 2 * third).tolist() == values[third:2 * third]


def test_outliers_become_exceptions_and_do_not_widen_a_block():
    ids = np.full(1024, 1000, np.uint32) + np.arange(1024, dtype=np.uint32) % 8
    ids[[5, 900]] = 4_000_000_000
    found = patched_blocks.encode(ids)
    assert found.widths.tolist() == [3] and found.minima.tolist() == [1000]
    assert found.places.tolist() == [5, 900] and len(found.words) == 3 * 16


def test_damaged_and_foreign_files_are_refused():
    content = bytearray(patched_blocks.shard_bytes(0, 0, [1], np.array([0, 3]), np.array([1, 2, 3], np.uint32)))
    content[-10] ^= 1
    with pytest.raises(ValueError, match="damaged"):
        patched_blocks.Shard(bytes(content))
    with pytest.raises(ValueError, match="not a file"):
        patched_blocks.Shard(b"x" * 100)


@settings(max_examples=80, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from(" \n\t\r\x1c\x85\xa0 　aBZ0'sStT'rȩİΣßﬁ漢😀٣½<|>endoftext,.")
                        | st.characters(codec="utf-8"), max_size=40), max_size=8))
def test_words_have_the_tokenizer_s_ids(texts):
    words = patched_blocks.words_of(TOKENIZER)
    assert words.by_word
    wanted = [np.array(words.tokenizer.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
    assert words.id_bytes(texts) == wanted


def test_a_worker_holds_few_words_and_looks_each_up_once_a_call(monkeypatch):
    words = patched_blocks.Words(TOKENIZER)
    asked = []
    monkeypatch.setattr(words, "_encode", lambda new: asked.append(sorted(new)) or {w: words._ids(w).tobytes() for w in new})
    texts = ["a b,\na", "", "<|a b", "b, c"]
    assert words.id_bytes(texts) == words.id_bytes(texts) == [words._ids(t).tobytes() for t in texts]
    assert asked == [["", "a", "b,", "c"], []]
    monkeypatch.setattr(words, "_encode", lambda new: dict.fromkeys(new, b"\1\0\0\0"))
    words.id_bytes([" ".join(map(str, range(600_000)))])
    assert len(words.known) <= 500_000


def test_remembered_words_are_bounded(monkeypatch):
    monkeypatch.setattr(patched_blocks, "REMEMBERED", 3)
    words = patched_blocks.Words(TOKENIZER)
    for _ in range(2):
        got = words.id_bytes(["one two three four five " + "x" * 100])
        assert got == [words._ids("one two three four five " + "x" * 100).tobytes()]
        assert len(words.known) == 3


def test_long_words_take_no_room_of_remembered_words(monkeypatch):
    monkeypatch.setattr(patched_blocks, "REMEMBERED", 3)
    words = patched_blocks.Words(TOKENIZER)
    words.id_bytes([" ".join(["x" * n for n in range(100, 200)] + ["one", "two", "three", "four"])])
    assert len(words.known) == 3 and set(words.known) <= {"one", "two", "three", "four"}


def test_vocabulary_that_keeps_white_space_is_used_whole():
    words = patched_blocks.Words(public_tokenizers.path("byte_bpe_50k.json"))
    assert not words.by_word
    assert words.id_bytes(["a  b\n0"]) == [words._ids("a  b\n0").tobytes()]


@pytest.mark.parametrize("shard_ids", [1, 5000, 1 << 23])
def test_token_files(spark, texts, tmp_path, shard_ids):
    tokenizer = patched_blocks.words_of(TOKENIZER).tokenizer
    path = str(tmp_path / "files")
    found = patched_blocks.token_files(frame(spark, texts), TOKENIZER, path=path, shard_ids=shard_ids).collect()
    own = []
    for doc_id, text in texts:
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        own.append((doc_id, len(ids), zlib.crc32(ids.tobytes())))
    assert sorted((repr(r["doc_id"]), r["n_tokens"], r["ids_crc32"]) for r in found) == sorted(
        (repr(i), n, c) for i, n, c in own)
    placed = sorted(found, key=lambda r: r["start"])
    assert [r["start"] for r in placed] == np.concatenate(([0], np.cumsum([r["n_tokens"] for r in placed])))[:-1].tolist()
    order = [(r["doc_id"] is not None, r["doc_id"] or 0) for r in placed]
    assert order == sorted(order)
    shards = [patched_blocks.Shard(f.read_bytes()) for f in (tmp_path / "files").glob("part-*") if f.stat().st_size]
    shards.sort(key=lambda s: (s.part, s.number))
    inside = [(bool(known), int(i)) for s in shards for i, known in zip(s.doc_ids, s.has_id)]
    assert inside == order and len({(s.part, s.number) for s in shards}) == len(shards)
    assert sum(s.n_ids for s in shards) == sum(n for _, n, _ in own)
    if shard_ids == 1:
        assert len(shards) == len(texts)


def test_rows_of_one_id_are_dealt_over_ranges():
    bounds = np.array([3, 5, 5, 5, 9])
    doc_ids, rows = np.repeat([1, 3, 4, 5, 9, 20], 50), np.tile(np.arange(50), 6)
    found = patched_blocks.range_of(doc_ids, np.ones(300, bool), rows, 2, bounds)
    wanted = {1: {2}, 3: {2, 3}, 4: {3}, 5: {3, 4, 5, 6}, 9: {6, 7}, 20: {7}}
    assert {d: set(found[doc_ids == d].tolist()) for d in wanted} == wanted
    assert set(patched_blocks.range_of(doc_ids, np.zeros(300, bool), rows, 2, bounds).tolist()) == {0, 1}
    assert set(patched_blocks.range_of(doc_ids, np.ones(300, bool), rows, 0, bounds[:0]).tolist()) == {0}


def test_one_id_for_a_third_of_the_rows(spark):
    rows = [(7 if i % 3 == 0 else None if i % 3 == 1 else i, f"text {i}") for i in range(90)]
    found = patched_blocks.token_files(frame(spark, rows), TOKENIZER, shard_ids=10).orderBy("start").collect()
    assert [(r["doc_id"] is not None, r["doc_id"] or 0) for r in found] == sorted((i is not None, i or 0) for i, _ in rows)
    assert found[-1]["start"] + found[-1]["n_tokens"] == sum(r["n_tokens"] for r in found)


def test_token_files_of_nothing(spark):
    assert patched_blocks.token_files(frame(spark, []), TOKENIZER).collect() == []


# -- fill in the middle ------------------------------------------------------------

@settings(max_examples=100, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from("ab é漢😀\x00")), min_size=1, max_size=6))
def test_exceptions_convert_both_ways(texts):
    whole = "".join(texts)
    index = fill_middle.Exceptions(np.frombuffer(whole.encode(), np.uint8))
    starts = np.cumsum([0, *(len(c.encode()) for c in whole)])
    assert index.to_bytes(np.arange(len(whole) + 1)).tolist() == starts.tolist()
    places = np.arange(starts[-1] + 1)
    assert index.to_chars(places).tolist() == (np.searchsorted(starts, places, "right") - 1).tolist()


def plain_middle(doc_id, text):
    text = text or ""
    n, digest = len(text), hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[i:i + 8], 16) for i in range(0, 32, 8)]
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return doc_id, n, "plain", text, None, None
    parts = text[:a], text[a:b], text[b:]
    if h[3] % 100 < 20:
        return doc_id, n, "spm", f"<S>{parts[2]}<P>{parts[0]}<M>{parts[1]}", a, b - a
    return doc_id, n, "psm", f"<P>{parts[0]}<S>{parts[2]}<M>{parts[1]}", a, b - a


def test_fill_in_middle(spark, texts):
    turned = fill_middle.fill_in_middle(frame(spark, texts))
    assert turned.columns == ["doc_id", "n", "form", "output", "prefix_chars", "middle_chars"]
    wanted = sorted(map(repr, (plain_middle(i, t) for i, t in texts)))
    assert sorted(repr(tuple(r)) for r in turned.collect()) == wanted
    assert {r["form"] for r in turned.collect()} == {"plain", "psm", "spm"}
    back = turned.select(fill_middle.restored().alias("text")).collect()
    assert sorted(r["text"] for r in back) == sorted(t or "" for _, t in texts)


def test_cuts_in_bytes_begin_characters(spark, texts):
    layout = fill_middle.Layout(unit="bytes", plain=0)
    for row in fill_middle.fill_in_middle(frame(spark, texts), layout).collect():
        if row["doc_id"] not in (None, 3) and row["form"] != "plain":
            text = dict(texts)[row["doc_id"]].encode()
            cuts = np.sort(fill_middle.draws([row["doc_id"]], "1:")[0, :2] % (len(text) + 1))
            chars = [len(text[:cut].decode(errors="ignore")) for cut in cuts]
            assert [row["prefix_chars"], row["prefix_chars"] + row["middle_chars"]] == chars


def test_markers_that_could_be_mistaken_are_refused():
    for markers in (("<a", "a<", "<M>"), ("<P>", "<P>", "<M>"), ("aba", "<S>", "<M>"), ("<P>", "P", "<M>"), ("", "a", "b")):
        with pytest.raises(ValueError):
            fill_middle.Layout(*markers)


def test_fill_in_middle_of_nothing(spark):
    assert fill_middle.fill_in_middle(frame(spark, [])).collect() == []


# -- whitening ---------------------------------------------------------------------

VECTORS = "vec_id BIGINT, embedding ARRAY<FLOAT>, label INT, component INT, n BIGINT"


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, 0, 1, 2) for i, v in rows], VECTORS).repartition(3)


def plain_whitening(rows, size):
    good = [(i, v) for i, v in rows if v is not None and len(v) == size and all(c is not None and np.isfinite(c) for c in v)]
    x = np.floor(1024 * np.array([np.array(v, np.float32).astype(float) for _, v in good])).astype(int) + 100_000
    n, total = len(x), x.sum(axis=0)
    a = (x * n - total) / n
    values, columns = np.linalg.eigh(a.T @ a / n)
    deviation = ((x * n - total) ** 2).sum(axis=1)
    return good, n, deviation, a @ columns[:, ::-1][:, :8] / np.sqrt(values[::-1][:8]), values[::-1] / values.sum()


@pytest.mark.parametrize("spread", [1.0, 0.05])
def test_whitening(spark, spread):
    rng = np.random.default_rng(4)
    data = rng.normal(size=(400, 12)) @ np.diag(spread ** np.arange(12) + 0.02) @ rng.normal(size=(12, 12))
    rows = [(i, [float(np.float32(c)) for c in v]) for i, v in enumerate(data)]
    rows += [(None, rows[3][1]), (5, rows[5][1]), (900, None), (901, [None] * 12), (902, [float("nan")] * 12),
             (903, [float("inf")] + [0.0] * 11), (904, [1.0] * 5), (905, []), (906, [3e38] * 12)]
    found = shifted_qr.whiten(vectors(spark, rows)).collect()
    good, n, deviation, white, explained = plain_whitening(rows[:-1], 12)
    assert len(found) == 8 * len(good) and {r["n"] for r in found} == {n}
    (error,) = {r["identity_error"] for r in found}
    assert error < 1e-9
    got = sorted((repr(r["vec_id"]), r["component"], r["deviation"], r["whitened"], r["explained"]) for r in found)
    sign = {}
    wanted = sorted((repr(i), c + 1, int(deviation[k]), white[k, c], explained[c]) for k, (i, _) in enumerate(good) for c in range(8))
    for g, w in zip(got, wanted):
        assert g[:3] == w[:3] and g[4] == pytest.approx(w[4], rel=1e-9)
        sign.setdefault(g[1], np.sign(g[3] * w[3]))
        assert g[3] * sign[g[1]] == pytest.approx(w[3], abs=1e-7)


def test_badly_conditioned_rows_become_orthonormal():
    rng = np.random.default_rng(1)
    a = rng.normal(size=(500, 20)) @ np.diag(10.0 ** -np.linspace(0, 10, 20)) @ np.linalg.qr(rng.normal(size=(20, 20)))[0]
    passes = []

    def gram_of(factors):
        q = shifted_qr.solve(a, factors)
        passes.append(q)
        return q.T @ q

    factors = shifted_qr.factors_of(gram_of, len(a))
    q = shifted_qr.solve(a, factors)
    assert len(passes) <= 5 and np.abs(q.T @ q - np.eye(20)).max() < 1e-12
    r = np.eye(20)
    for factor in factors:
        r = factor @ r
    assert np.allclose(np.tril(r, -1), 0) and np.abs(q @ r - a).max() < 1e-14
    assert np.allclose(np.linalg.svd(r)[1], np.linalg.svd(a)[1], rtol=1e-6)


def test_components_without_an_eigenvalue_are_left_out(spark):
    rows = [(i, [float(i % 7), 2.0 * (i % 7), 5.0]) for i in range(30)]
    found = shifted_qr.whiten(vectors(spark, rows)).collect()
    assert {r["component"] for r in found} == {1} and len(found) == 30
    assert found[0]["identity_error"] < 1e-9 and found[0]["explained"] == pytest.approx(1)
    for same in ([], rows[:1], rows[:1] * 5, [(1, None)]):
        assert shifted_qr.whiten(vectors(spark, same)).collect() == []


def test_deviation_is_exact_or_null():
    for n, widest in ((3, 10), (1_000_003, 3000), (2_000_000, 40_000), (1 << 40, 1 << 30)):
        total = np.array([7, n * 5 + 1], object)
        x = np.array([[0, 5], [widest, -widest], [widest // 2, 3]])
        centre = shifted_qr.Centre(n, total, x.min(axis=0), x.max(axis=0))
        exact = [sum((n * int(c) - int(s)) ** 2 for c, s in zip(row, total)) for row in x]
        assert centre.deviation(x) == [e if e < 1 << 63 else None for e in exact]
