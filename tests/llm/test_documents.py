"""The document operators against plain Python on small fixtures with every odd case."""

import hashlib
import random
import re
import tracemalloc
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyloom.llm import bin_slack, circulant_minhash, line_chunks, pu_quality, suffix_decon, target_llr
from tallyloom.llm.queries import byte_subwords

SCHEMA = "doc_id BIGINT, text STRING, kept STRING, start STRING, _row STRING"
WORDS = ["the", "Of", "ndor", "é", "tion", "Thé", "ble,", "x1", "#tag", "in"]


def prose(rng, n, line=9):
    words = [rng.choice(WORDS) + rng.choice(["", "ing", "ed", "er"]) for _ in range(n)]
    return "\n".join(" ".join(words[i:i + line]) for i in range(0, n, line))


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(3)
    base = [prose(rng, n) for n in (5, 40, 120, 300, 80, 60)]
    shared = prose(rng, 90)
    near = base[2].replace("the", "thus", 1)
    rows = [*base, base[3], near, base[1] + "\n" + shared, prose(rng, 30) + "\n" + shared, "", None, " \n\t ",
            "one two", "one two", "One TWO", "a " * 4000, base[4] + " " + base[5]]
    return list(enumerate(rows)) + [(None, base[2]), (3, base[3]), (1, "other words under a used id " * 5)]


@pytest.fixture(scope="module")
def documents(spark, texts):
    return spark.createDataFrame([(i, t, "k", "s", "r") for i, t in texts], SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


# -- quality rules ---------------------------------------------------------------

def base_rules(text):
    words = words_of(text)
    lines = [line for line in (text or "").split("\n") if words_of(line)]
    windows = defaultdict(list)
    for i in range(len(words) - 7):
        windows[tuple(words[i:i + 8])].append(i)
    hit = {p for at in windows.values() if len(at) > 1 for i in at for p in range(i, i + 8)}
    n = len(words)
    failed = n < 20 or 100 * len(hit) > 30 * n
    return (n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)),
            len(hit), failed)


def test_quality_rules_base(documents, texts):
    ratios = target_llr.Ratios(np.zeros(1 << 10))
    rows = target_llr.judge(documents, ratios).collect()
    assert len(rows) == len(texts) and {"start", "_row"} <= set(rows[0].asDict())
    got = sorted((r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in rows)
    assert got == sorted(base_rules(t) for _, t in texts)
    assert all(r.kept == (not r.base_failed) for r in rows)


def test_quality_rules_ratio_counts_all_grams(spark):
    target = spark.createDataFrame([("good words here " * 10,)], "text STRING")
    raw = spark.createDataFrame([("good words here " * 10,), ("BAD!! stuff!! now!! " * 10,), (None,), ("",)], "text STRING")
    counted = {r.bucket: r.n for r in target_llr.bucket_counts(raw, 1 << 12).collect()}
    assert sum(counted.values()) == 2 * (30 + 29)
    ratios = target_llr.fit(raw, target, 1 << 12, prior=0.001)
    both = raw.withColumn("doc_id", F.monotonically_increasing_id())
    found = [(r.n_words, r.llr) for r in target_llr.judge(both, ratios).collect()]
    good, bad = max(x for n, x in found if n), min(x for n, x in found if n)
    assert good > 0.3 > -0.3 > bad and [x for n, x in found if not n] == [0.0, 0.0]


def test_quality_rules_empty(nothing, spark):
    ratios = target_llr.fit(nothing, nothing.select("text"), 1 << 8)
    assert not ratios.log_ratio.any()
    assert target_llr.judge(nothing, ratios).count() == 0
    labels = spark.createDataFrame([(1, 1), (1, 1), (None, 1), (2, 0)], "doc_id BIGINT, quality INT")
    docs = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (None, "d")], "doc_id BIGINT, text STRING")
    for threshold in ("-1", "10485760"):  # one plan at every size
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        try:
            trusted = target_llr.trusted_texts(docs, labels)
            assert sorted(r.text for r in trusted.collect()) == ["a", "b"]
            plan = trusted._jdf.queryExecution().executedPlan().toString()
            assert "SortMergeJoin" in plan and "Broadcast" not in plan
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


# -- line dedup ------------------------------------------------------------------

def dedup_in_python(rows):
    """Remove chunks whose bytes stand at an earlier (doc_id, row) place."""
    places = defaultdict(set)
    for doc_id, text in rows:
        for at, chunk in line_chunks._chunks(None if text is None else text.encode()):
            places[chunk].add(((doc_id is not None, doc_id or 0), text, at[0]))
    result = []
    for doc_id, text in rows:
        if text is None:
            result.append((doc_id, None))
            continue
        lines, drop = text.split("\n"), set()
        for at, chunk in line_chunks._chunks(text.encode()):
            # the first place is the least id; under one id the operator orders by a hash
            own, first = (doc_id is not None, doc_id or 0), min(p[0] for p in places[chunk])
            if len(places[chunk]) > 1 and (own != first or min(p[2] for p in places[chunk] if p[0] == first) != at[0]):
                drop.update(at)
        result.append((doc_id, "\n".join(x for i, x in enumerate(lines) if i not in drop)))
    return result


def order(rows):
    return sorted(rows, key=lambda r: tuple((v is not None, v or "") if isinstance(v, str) or v is None else (True, v) for v in r))


def test_line_dedup_against_python(spark, texts):
    rows = [r for r in texts if not (r[0] == 1 and (r[1] or "").startswith("other"))]
    docs = spark.createDataFrame([(i, t, "k", "s", "r") for i, t in rows], SCHEMA)
    got = [(r.doc_id, r.text) for r in line_chunks.dedup_lines(docs).collect()]
    assert Counter(got) == Counter(dedup_in_python(rows))
    assert any((t or "") != (dict(rows)[i] or "") for i, t in got if i is not None)


def test_chunks_resist_shifts():
    rng = random.Random(5)
    shared = prose(rng, 400, 8).encode().split(b"\n")
    cut = lambda before: {
        tuple(lines[i] for i in c) for lines in [[*before, *shared]] for c in line_chunks.chunk_places(lines)}
    plain, shifted = cut([]), cut([b"something new", b"and more of it", b"here"])
    assert len(plain & shifted) >= 0.8 * len(plain)


def test_passages_are_removed_whole_in_any_host(spark):
    """Each repeated run of over 50 words goes, found by comparing all runs of lines."""
    rng = random.Random(11)
    fresh = iter(range(10**6))
    own = lambda n: [" ".join(f"w{next(fresh)}" for _ in range(rng.choice([3, 9, 20]))) for _ in range(n)]
    rows = []
    for k in range(2, 9):
        lines = own(k)
        lines[-1] += " " + " ".join(f"w{next(fresh)}" for _ in range(max(0, 51 - sum(len(x.split()) for x in lines))))
        for _ in range(3):
            host = own(6)
            at = rng.randrange(7)
            rows.append([*host[:at], *lines[:1], "", *lines[1:], *host[at:]])
    short = [" ".join(f"w{next(fresh)}" for _ in range(50))]
    rows += [[*own(1), *short, *own(1)] for _ in range(2)]
    rows += [["a b c d e f g h i j"] * 20, [*own(2), *rows[0], *own(2)]]
    seen, want = set(), []
    for lines in rows:
        worded = [i for i, x in enumerate(lines) if x.strip()]
        runs = [(a, b) for a in range(len(worded)) for b in range(a, len(worded))
                if sum(len(lines[i].split()) for i in worded[a:b + 1]) > 50]
        text = lambda a, b: tuple(lines[i] for i in worded[a:b + 1])
        drop, first = set(), {}
        for a, b in runs:
            if text(a, b) in seen:
                drop.update(worded[a:b + 1])
            else:
                at = first.setdefault(text(a, b), b)
                drop.update(i for i in worded[a:b + 1] if at < b and i > worded[at])
        seen.update(text(a, b) for a, b in runs)
        want.append([x for i, x in enumerate(lines) if i not in drop])
    docs = spark.createDataFrame([(i, "\n".join(x), "k", "s", "r") for i, x in enumerate(rows)], SCHEMA).repartition(3)
    got = {r.doc_id: r for r in line_chunks.dedup_passages(docs).collect()}
    passages = len(rows) - 4
    for i, lines in enumerate(want):
        if i not in (passages + 2,):  # lines of one word sequence also form equal chunks
            assert got[i].text.split("\n") == lines, i
    assert sum(r.n_removed_lines for r in got.values()) > 60
    assert 5 <= len(got[passages + 2].text.split("\n")) <= 6 and len(got) == len(rows)


def test_long_lines_and_small_chunks():
    long = b"word " * 51
    assert line_chunks.chunk_places([long.strip()]) == [[0]]
    assert line_chunks.chunk_places([b"one line"]) == [] == line_chunks.chunk_places([b"", b"  "])


def test_line_dedup_repeats_inside_and_empty(spark, nothing):
    passage = "\n".join(f"line number {i} of this passage" for i in range(12))
    docs = spark.createDataFrame([(1, passage, 5), (2, passage + "\n\n", 6)], "doc_id BIGINT, text STRING, n_removed_lines INT")
    got = {r.doc_id: r for r in line_chunks.dedup_lines(docs).collect()}
    assert got[1].text == passage and got[1].n_removed_lines == 0
    assert got[2].n_removed_lines >= 10 and got[2].n_removed_words >= 50
    assert line_chunks.dedup_lines(nothing).count() == 0


def test_a_digest_of_two_texts_removes_nothing(spark, monkeypatch):
    docs = spark.createDataFrame([(1, "a b\nc d"), (2, "a b\nc d"), (3, "e f\ng h"), (4, "e f\ng h")], "doc_id BIGINT, text STRING")
    real = line_chunks.chunk_rows
    monkeypatch.setattr(line_chunks, "chunk_rows", lambda d, b: real(d, b).withColumn("digest", F.lit(b"same")))
    assert line_chunks.repeated_chunks(docs).count() == 0


# -- near duplicates -------------------------------------------------------------

def shingles(text):
    w = words_of("".join(c.lower() if c.isascii() else c for c in text or ""))
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def components_in_python(rows):
    sets = [(i, shingles(t)) for i, t in rows]
    root = list(range(len(sets)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a in range(len(sets)):
        for b in range(a):
            (i, x), (j, y) = sets[a], sets[b]
            if x and y and i is not None and j is not None and 100 * len(x & y) >= 75 * len(x | y):
                root[find(a)] = find(b)
    least = {}
    for k, (i, _) in enumerate(sets):
        if i is not None:
            least[find(k)] = min(i, least.get(find(k), i))
    return Counter((i, len(s), None if i is None else least[find(k)]) for k, (i, s) in enumerate(sets))


def test_near_duplicates_against_all_pairs(documents, texts):
    rows = circulant_minhash.near_duplicates(documents).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in rows) == components_in_python(texts)
    assert all(r.kept == (r.doc_id is None or r.doc_id == r.component_id) for r in rows)


def test_near_duplicate_chains_and_crowds(spark):
    rng = random.Random(9)
    base = [rng.choice(WORDS) + str(rng.randrange(900)) for _ in range(120)]
    rows = []
    for i in range(60):  # each differs from the last, so that ends are far apart
        base[rng.randrange(120)] = f"new{i}"
        rows.append((i, " ".join(base)))
    crowd = [rng.choice(WORDS) + str(rng.randrange(900)) for _ in range(100)]
    for i in range(60, 110):
        own = list(crowd)
        for _ in range(2):
            own[rng.randrange(100)] = f"edit{i}"
        rows.append((i, " ".join(own)))
    rng.shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id BIGINT, text STRING")
    got = circulant_minhash.near_duplicates(docs).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == components_in_python(rows)
    kept = circulant_minhash.drop_near_duplicates(docs).collect()
    assert {r.doc_id for r in kept} == {r.component_id for r in got}


def test_near_duplicates_empty(nothing):
    assert circulant_minhash.near_duplicates(nothing).count() == 0


def test_signature_coordinates_are_shifted_reads_of_one_permutation():
    some = np.array([5, 77, 123456789], np.uint64)
    sig = circulant_minhash.signature(some, 64)
    order = np.random.default_rng(8).permutation(circulant_minhash.UNIVERSE)
    first = (some * circulant_minhash._ODD >> np.uint64(44)).astype(int)
    assert sig.tolist() == [min(order[(x + k) % len(order)] for x in first) for k in range(64)]


def test_signatures_estimate_similarity():
    rng = np.random.default_rng(1)
    pool = rng.integers(0, 1 << 63, 4000, dtype=np.uint64)
    a, b = pool[:2000], pool[500:2500]
    same = (circulant_minhash.signature(a) == circulant_minhash.signature(b)).mean()
    assert abs(same - 0.6) < 0.09


# -- decontamination -------------------------------------------------------------

def bench_words(text):
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text)


def contamination_in_python(rows, items):
    result = Counter()
    for doc_id, text in rows:
        w, hit, found = bench_words(text), set(), set()
        for item_id, item in items:
            v = bench_words(item)
            size = min(len(v), 13)
            wins = {tuple(v[i:i + size]) for i in range(len(v) - size + 1)} if v else set()
            for i in range(len(w) - size + 1 if v else 0):
                if tuple(w[i:i + size]) in wins:
                    hit.update(range(i, i + size))
                    found.add(str(item_id))
        listed = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        result[doc_id, len(w), len(hit), len(found), listed, bool(hit) and 20 * len(hit) >= len(w)] += 1
    return result


@pytest.mark.parametrize("block_bytes", [8 << 20, 150])
def test_decontamination_against_python(spark, block_bytes):
    rng = random.Random(4)
    pool = [f"w{i}" for i in range(40)]
    passage = [" ".join(rng.choice(pool) for _ in range(n)) for n in (13, 14, 30, 60, 5, 1, 12)]
    items = [(i, p) for i, p in enumerate(passage)] + [(100, passage[1].upper()), (101, None), (102, "!?"), (7, "w1 w2-w3")]
    rows = []
    for i in range(60):
        noise = [rng.choice(pool) for _ in range(rng.choice([0, 3, 50, 400]))]
        at = rng.randrange(len(noise) + 1)
        own = passage[rng.randrange(7)].split() if i % 2 else passage[3].split()[5:rng.choice([17, 18, 19, 40])]
        rows.append((i, " ".join([*noise[:at], *own, *noise[at:]]).replace("w1 ", "W1, ")))
    rows += [(60, None), (61, ""), (62, passage[2] + " " + passage[2]), (62, passage[2]), (None, passage[0])]
    docs = spark.createDataFrame(rows, "doc_id BIGINT, text STRING").withColumn("n_hit", F.lit("x"))
    bench = spark.createDataFrame(items, "item_id BIGINT, text STRING")
    got = suffix_decon.contamination(docs, bench, block_bytes).collect()
    names = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    assert Counter(tuple(r[n] for n in names) for r in got) == contamination_in_python(rows, items)
    clean = suffix_decon.decontaminate(docs, bench, block_bytes)
    assert clean.columns == docs.columns
    assert clean.count() == sum(n for k, n in contamination_in_python(rows, items).items() if not k[-1])


def test_longest_match_and_places(spark):
    item = " ".join(f"q{i}" for i in range(40))
    doc = "start here " + " ".join(f"q{i}" for i in range(5, 30)) + " and " + " ".join(f"q{i}" for i in range(13))
    docs = spark.createDataFrame([(1, doc)], "doc_id BIGINT, text STRING")
    r = suffix_decon.contamination(docs, spark.createDataFrame([("a", item)], "item_id STRING, text STRING")).first()
    assert r.longest == 25 and [(s.start, s.length) for s in r.spans] == [(2, 25), (28, 13)]


def test_rows_under_one_id_and_items_without_id(spark):
    rng = random.Random(8)
    one, other = prose(rng, 120), " ".join(f"u{i}" for i in range(80))
    docs = spark.createDataFrame([(1, one), (2, one), (2, other), (3, None)], "doc_id BIGINT, text STRING")
    kept = circulant_minhash.drop_near_duplicates(docs).collect()
    assert sorted((r.doc_id, r.text or "") for r in kept) == sorted([(1, one), (2, other), (3, "")])
    bench = spark.createDataFrame([(None, other), (None, "zz " * 20), (7, "yy " * 20)], "item_id BIGINT, text STRING")
    for block_bytes in (50, 1 << 20):
        found = {r.doc_id: r for r in suffix_decon.contamination(docs.where("text like 'u0%' or doc_id = 1"), bench, block_bytes).collect()}
        assert (found[2].n_hit, found[2].contaminated, found[2].n_items) == (80, True, 1)
        assert found[2].items_sha256 == hashlib.sha256(b"").hexdigest() and found[1].n_hit == 0
        assert other not in {r.text for r in suffix_decon.decontaminate(docs, bench, block_bytes).collect()}


def test_decontamination_empty(spark, nothing, documents):
    none = spark.createDataFrame([], "item_id BIGINT, text STRING")
    assert suffix_decon.contamination(nothing, none).count() == 0
    assert suffix_decon.decontaminate(documents, none).count() == documents.count()


# -- packing ---------------------------------------------------------------------

def test_packing_round_trip(documents, texts):
    from public_tokenizers import path
    from tokenizers import Tokenizer

    exact = Tokenizer.from_file(path("byte_bpe_50k.json"))
    rows = bin_slack.pack(documents, byte_subwords(), group_pieces=5).collect()
    want = Counter()
    for doc_id, text in texts:
        ids = np.array([*exact.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        want.update((doc_id, s, len(ids[s:s + 1024]), zlib.crc32(ids[s:s + 1024].tobytes()), len(ids))
                    for s in range(0, len(ids), 1024))
    assert Counter((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in rows) == want
    by_sequence = defaultdict(list)
    for r in rows:
        by_sequence[r.sequence_id].append((r.offset, r.length))
    for parts in by_sequence.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= 1024


def test_subwords_keep_nothing_of_what_they_encode():
    subwords = byte_subwords()
    subwords.id_bytes(b"loaded once")
    tracemalloc.start()
    subwords.id_bytes(" ".join(f"word{i}x{i}" for i in range(30_000)).encode())
    held = tracemalloc.get_traced_memory()[0]
    tracemalloc.stop()
    assert held < 200_000


def test_packing_empty(nothing):
    assert bin_slack.pack(nothing, byte_subwords()).count() == 0


def test_best_fill_is_the_best_sum():
    rng = np.random.default_rng(6)
    for _ in range(200):
        room = int(rng.integers(1, 40))
        lengths = rng.integers(1, 30, rng.integers(0, 9))
        counts = np.bincount(lengths, minlength=64)
        used = bin_slack.best_fill(counts, room)
        sums = {0}
        for n in lengths.tolist():
            sums |= {s + n for s in sums if s + n <= room}
        assert sum(used) == max(sums)
        assert (np.bincount(used, minlength=64) <= counts).all()


def test_little_padding():
    lengths = np.random.default_rng(7).integers(1, 1024, 5000)
    window, offset = bin_slack.pack_lengths(lengths)
    filled = np.bincount(window, lengths)
    assert filled.max() <= 1024 and 1 - filled.sum() / (1024 * len(filled)) < 0.01


@pytest.mark.parametrize("text", [
    "", " ", "a", "  a  b", "a\n", "a\n\nb", "\n\n\nb", "a\t b", "it's  we'll\n 'll", "é à x  y", "1234 567,8!! ...",
    "<|endoftext|> x", "x<|endoftext|>", "漢字 かな\nx", "a\x1cb \x1dc", "a 　b", "\\### Assistant: </turn> ok"])
def test_subwords_equal_the_tokenizer(text):
    from public_tokenizers import path
    from tokenizers import Tokenizer

    ids = np.frombuffer(byte_subwords().id_bytes(text.encode()), "<u4").tolist()
    assert ids == Tokenizer.from_file(path("byte_bpe_50k.json")).encode(text, add_special_tokens=False).ids


# -- quality classifier ------------------------------------------------------------

def test_classifier_learns_from_positives_and_unlabelled(spark):
    rng = random.Random(11)
    good = [" ".join(rng.choice(WORDS) + rng.choice("abcd") for _ in range(60)) for _ in range(240)]
    bad = [" ".join(rng.choice(WORDS).upper() + "!!" for _ in range(60)) for _ in range(60)]
    rows = list(enumerate(good + bad)) + [(None, "x"), (400, None), (401, "")]
    docs = spark.createDataFrame(rows, "doc_id BIGINT, text STRING")
    trusted = docs.where("doc_id < 100").select("doc_id")
    network = pu_quality.fit(docs, trusted)
    scores = pu_quality.score(docs.withColumn("score", F.lit("clash")), network).collect()
    assert len(scores) == len(rows) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in scores)
    by_id = {r.doc_id: r.predicted for r in scores}
    assert sum(by_id[i] for i in range(100, 240)) > 130 and sum(by_id[i] for i in range(240, 300)) < 6
    assert 0.5 < network.prior < 0.95


def test_classifier_without_data(nothing, documents):
    network = pu_quality.fit(nothing, nothing.select("doc_id"))
    assert {r.score for r in pu_quality.score(documents, network).collect()} == {0.5}
    assert pu_quality.score(nothing, network).count() == 0


def test_non_negative_step_turns_back():
    f_p, f_u = np.array([5.0, 5.0]), np.array([-6.0, -6.0])
    slope_p, slope_u, forward = pu_quality.nn_pu_gradient(f_p, f_u, 0.9)
    assert not forward and (slope_p > 0).all() and (slope_u < 0).all()


def test_features_are_finite_and_per_text():
    texts = [None, b"", b"one", b"THE!! BIG!!", b"a b a b\na b a b", "é".encode()]
    table = pu_quality.features(texts)
    assert np.isfinite(table).all() and not table[:2].any()
    assert np.allclose(pu_quality.features(texts[3:4])[0], table[3])


def test_a_line_hash_of_two_texts_sets_windows_aside(spark, monkeypatch):
    words = " ".join(f"w{i}" for i in range(40))
    docs = spark.createDataFrame(
        [(1, f"a {words}\nb {words}"), (2, f"x\n\na {words}\nb {words}\ny"), (3, f"c {words}\nd {words}\nz"),
         (4, f"q\nc {words}\nd {words}")], "doc_id BIGINT, text STRING")
    spans = lambda: {r.doc_id: sorted(map(tuple, r._spans)) for r in line_chunks.window_removals(docs).collect()}
    assert spans() == {2: [(2, 3)], 4: [(1, 2)]}
    real = line_chunks._mistaken_lines
    first = f"a {words}".encode()

    def mistaken(found):
        return found.where(F.col("line") == F.lit(first)).select("hash", "check").unionByName(real(found).select("hash", "check"))

    monkeypatch.setattr(line_chunks, "_mistaken_lines", mistaken)
    assert spans() == {4: [(1, 2)]}


def test_sieve(spark):
    from tallyloom.llm import sieve

    keys = spark.range(500).select(F.xxhash64("id").alias("h"))
    others = spark.range(500, 20_000).select(F.xxhash64("id").alias("h"))
    words = sieve.marked(keys, F.col("h"))
    assert sieve.passing(keys, words, F.col("h")).count() == 500
    assert sieve.passing(others, words, F.col("h")).count() < 20
    held = sieve.Sieve.of(keys, F.col("h"))
    assert held.holds(np.array([r.h for r in keys.collect()])).all()
    assert held.holds(np.array([r.h for r in others.collect()])).sum() == sieve.passing(others, words, F.col("h")).count()
    nothing = sieve.marked(keys.limit(0), F.col("h"))
    assert sieve.passing(others, nothing, F.col("h")).count() == 0


def test_quality_classifier_takes_one_row_of_a_repeated_id(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(pu_quality, "fit_network", lambda p, u: seen.append((p, u)))
    texts = ["one two three four", "five!!! six 7 8 9", "ten"]
    docs = spark.createDataFrame([(1, t) for t in texts * 50] + [(2, texts[0]), (None, "x")], "doc_id BIGINT, text STRING")
    pu_quality.fit(docs, docs.where("doc_id = 1").select("doc_id"))
    positives, unlabelled = seen[0]
    features = pu_quality.features([t.encode() for t in texts]).tolist()
    assert positives.tolist() == [min(features)]
    assert sorted(unlabelled.tolist()) == sorted([min(features), features[0]])


def test_features_do_not_depend_on_other_texts():
    texts = [b"ten", b"ten", b"ten ten", b"ten", b"", None, b"ten\nten ten!!!", b"ten!!!"]
    together = pu_quality.features(texts)
    assert together.tolist() == [pu_quality.features([t])[0].tolist() for t in texts]
