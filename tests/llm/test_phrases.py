"""Repeated phrases, spelling variants and whitened vectors against brute force."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from rillmart.llm import phrase_automata, spelling_variants, whitening
from rillmart.llm.queries import QUERIES
from tests.llm.conftest import DOCUMENT, ODD

# --- phrases ------------------------------------------------------------------------


def brute_phrases(rows, size=13):
    """Number of words, spans removed and kept words of each row, from all windows of all rows."""
    texts = [(i, re.findall(rb"[^\x20\x09-\x0d]+", (t or "").encode())) for i, t in rows]
    first = {}
    for i, words in texts:
        if i is not None:
            for k in range(len(words) - size + 1):
                w = tuple(words[k : k + size])
                first[w] = min(first.get(w, i), i)
    out = []
    for i, words in texts:
        gone = [False] * len(words)
        if i is not None:
            for k in range(len(words) - size + 1):
                if first[tuple(words[k : k + size])] < i:
                    gone[k : k + size] = [True] * size
        kept = b" ".join(w for w, g in zip(words, gone) if not g)
        out.append((i, len(words), sum(gone), kept.decode()))
    return sorted(out, key=str)


def phrases(docs):
    rows = phrase_automata.remove_phrases(docs).collect()
    return sorted(((r.doc_id, r.n_words, sum(s.end - s.begin for s in r.spans), r.kept) for r in rows), key=str)


def repeated_rows(seed, count=60):
    rng = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(40)] + ["ü", "日本", "X", "x"]
    passages = [[rng.choice(vocabulary) for _ in range(rng.choice([12, 13, 14, 30, 90]))] for _ in range(8)]
    rows = []
    for i in rng.sample(range(-20, 200), count):
        words = []
        for _ in range(rng.choice([0, 1, 2, 4])):
            words += [rng.choice(vocabulary) for _ in range(rng.choice([0, 3, 20]))]
            p = rng.choice(passages)
            a = rng.randrange(len(p))
            words += rng.choice([p, p[a:], p[: a + 1], p[:a] + ["other"] + p[a:]])
        rows.append((i, rng.choice([" ", "\n", "\t \x0b"]).join(words)))
    return rows + rows[:3] + [(None, rows[0][1]), (rows[1][0], rows[2][1]), (999, None), (998, " \x0c ")]


@pytest.mark.parametrize("seed", [1, 2])
def test_phrases_equal_all_windows(spark, seed, monkeypatch):
    rows = repeated_rows(seed)
    if seed == 2:
        monkeypatch.setattr(phrase_automata, "SHARD_BYTES", 2000)
    docs = spark.createDataFrame([(i, t, "en", "s", 1, "x", 0) for i, t in rows], DOCUMENT + ", kept string, spans int")
    assert phrases(docs.repartition(4)) == brute_phrases(rows)


def test_chunks_hold_each_window_once(monkeypatch):
    rows = repeated_rows(4)
    batch = pa.RecordBatch.from_pydict({"doc_id": pa.array([i for i, _ in rows], pa.int64()), "text": [t for _, t in rows]})

    def windows():
        found = []
        for _, c in phrase_automata.chunks([batch]):
            hashes, anchors = c.hashes(c.window, 13).tolist(), c.hashes(c.anchor, phrase_automata.PIECE).tolist()
            found += list(zip((c.window + c.begin).tolist(), (c.anchor + c.begin).tolist(), hashes, anchors, c.doc.tolist()))
        return found

    whole = windows()
    monkeypatch.setattr(phrase_automata, "CHUNK", 50)
    phrase_automata._powers.cache_clear()
    parts = windows()
    phrase_automata._powers.cache_clear()
    assert parts == whole and len(whole) > 500


def test_blocks_of_a_shard_find_what_one_automaton_finds(monkeypatch):
    rng = random.Random(6)
    words = [f"w{k}".encode() for k in range(30)]
    learned = [b" ".join(rng.choices(words, k=n)) for n in (13, 200, 14, 60, 90)]
    waiting = [(k, 0, 5, b" ".join([b"x", *p.split()[k : k + 40], b"y"])) for k, p in enumerate(learned)]

    def found():
        shard, out = phrase_automata.Shard(), []
        for phrase in learned:
            shard.learn(phrase)
        for row in waiting:
            shard.waiting.append(row)
            out += shard.drain()
        covered = {(row, place) for row, _, a, b in out for place in range(a, b)}
        return len(shard.blocks), covered

    blocks, whole = found()
    monkeypatch.setattr(phrase_automata, "BLOCK", 20)
    more, parts = found()
    assert blocks == 1 and more > 5 and parts == whole and len(whole) > 100


def test_phrases_of_many_shards_and_tasks(spark, monkeypatch):
    monkeypatch.setattr(phrase_automata, "PHRASE_BYTES", 300)
    monkeypatch.setattr(phrase_automata, "STREAM_BYTES", 500)
    rows = repeated_rows(3)
    assert phrases(spark.createDataFrame(rows, "doc_id long, text string")) == brute_phrases(rows)


def test_phrases_of_odd_and_long_texts(spark, odd, empty):
    assert phrases(odd) == brute_phrases(ODD)
    assert phrases(empty) == []
    long = " ".join(f"t{k % 9000}" for k in range(400_000))
    rows = [(1, "y" * 3000 + " " + long), (2, "z " + long + " " + "q" * 2_000_000), (3, "y" * 3000 + " " + long[:100])]
    assert phrases(spark.createDataFrame(rows, "doc_id long, text string")) == brute_phrases(rows)


def test_long_words_hash_alike_in_any_surroundings():
    parts = [b"a", b"b" * 3000, b"cc", b"d" * 2000, b"b" * 3000, b"e"]
    def hashes(words):
        buf = np.frombuffer(b" ".join(words), dtype=np.uint8)
        end = np.cumsum([len(w) + 1 for w in words]) - 1
        return phrase_automata.word_hashes(buf, end - [len(w) for w in words], end).tolist()
    whole = hashes(parts)
    assert whole == [hashes([p])[0] for p in parts] and len(set(whole)) == 5


def test_phrase_query_equals_brute_force(spark, small):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{small}/documents.parquet").collect()]
    expected = {(i, n, gone, hashlib.sha256(kept.encode()).hexdigest()) for i, n, gone, kept in brute_phrases(rows)}
    got = {(r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in QUERIES["op11_phrase_automata"](spark, small).collect()}
    assert got == expected and any(gone for _, _, gone, _ in expected)


# --- spelling -----------------------------------------------------------------------


def near(a, b):
    """Whether one inserted, deleted or replaced character turns ``a`` into ``b``."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute_words(rows):
    n = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            n[run] += 1
    return {w: c for w, c in n.items() if len(w) >= 6 and c >= 5}


def brute_variants(n):
    table = {}
    for w in n:
        found = [v for v in n if near(w, v)]
        form = min(found, key=lambda v: (-n[v], v)) if found else None
        form = form if form and n[form] >= 5 * n[w] else None
        table[w] = (form, len(found))
    out = set()
    for w, (form, count) in table.items():
        root = w
        while table[root][0]:
            root = table[root][0]
        out.add((w, form, root, n[w], count, n[form] if form else None))
    return out


def variants(frame):
    return {(r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in frame.collect()}


def spelled_rows(seed):
    rng = random.Random(seed)
    letters = "abÀéÿ÷" if seed % 2 else "abcdefgh"
    bases = ["".join(rng.choice(letters) for _ in range(rng.choice([6, 7, 9, 14]))) for _ in range(25)] + ["aaaaaaaa", "ababababab"]
    rows = []
    for i in range(300):
        words = []
        for _ in range(30):
            w = rng.choice(bases[: 1 + int(len(bases) * rng.random() ** 3)])
            for _ in range(rng.choice([0, 0, 0, 1, 1, 2])):
                k = rng.randrange(len(w))
                w = rng.choice([w[:k] + w[k + 1 :], w[:k] + rng.choice(letters[:2]) + w[k:], w[:k] + letters[0] + w[k + 1 :]])
            words.append(rng.choice([w, w.upper()]) if w.isascii() else w)
        rows.append((i, rng.choice([" ", "-", "1", "ā"]).join(words)))
    return rows + [(None, rows[0][1]), (5, None), (6, ""), rows[1], rows[1]]


@pytest.mark.parametrize("seed,bucket", [(1, 1000), (2, 1000), (3, 2), (4, 1)])
def test_variants_equal_all_pairs(spark, seed, bucket, monkeypatch):
    monkeypatch.setattr(spelling_variants, "BUCKET", bucket)
    rows = spelled_rows(seed)
    docs = spark.createDataFrame([(i, t, "w", 1) for i, t in rows], "doc_id long, text string, word string, n int").repartition(3)
    n = brute_words(rows)
    assert {(r.word, r.n) for r in spelling_variants.words(docs).collect()} == set(n.items()) and len(n) > 100
    expected = brute_variants(n)
    assert variants(spelling_variants.variants(docs)) == expected
    assert any(f for _, f, *_ in expected) and max(c for *_, c, _ in expected) > 3


def test_roots_follow_long_chains(spark):
    chain = ["aaaaaaaa", "aaaaaaab", "aaaaaabb", "aaaaabbb", "aaaabbbb", "aaabbbbb"]
    text = " ".join(" ".join([w] * (6 * 6**k)) for k, w in enumerate(chain))
    rows = [(k, t) for k, t in enumerate([text, "zzzzzz " * 5])]
    assert variants(spelling_variants.variants(spark.createDataFrame(rows, "doc_id long, text string"))) == brute_variants(brute_words(rows))


def test_variants_of_odd_and_empty_tables(odd, empty):
    assert variants(spelling_variants.variants(odd)) == brute_variants(brute_words(ODD))
    assert spelling_variants.variants(empty).count() == 0


def test_pivots_are_the_cheapest_disjoint_pair():
    rng = random.Random(7)
    for _ in range(200):
        word = "".join(rng.choice("abc") for _ in range(rng.choice([6, 8])))
        weight = defaultdict(lambda: 0, {g: rng.randrange(9) for g in spelling_variants.grams(word)})
        chosen = spelling_variants.prefix(word, weight)
        by_place = {i: w for w, i in chosen}
        best = min(by_place[i] + by_place[j] for i in by_place for j in by_place if j >= i + 2)
        a, b = spelling_variants.pivots(chosen)
        assert b >= a + 2 and by_place[a] + by_place[b] == best


def test_variant_query_equals_brute_force(spark, small):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{small}/documents.parquet").collect()]
    assert variants(QUERIES["op12_spelling_variants"](spark, small)) == brute_variants(brute_words(rows))


# --- whitening ----------------------------------------------------------------------


def brute_whitened(vectors, components=16):
    """For the usable vectors: n, exact deviations, and the leading eigenpairs of the fit list's covariance."""
    kept = [(i, v) for i, v in vectors if v is not None and all(c is not None and np.isfinite(c) for c in v)]
    whole = [(i, tuple(int(np.floor(64 * float(c))) + 1000000 for c in v)) for i, v in kept]
    fit = np.array(sorted({x for _, x in whole}), dtype=object)
    n, sums = len(fit), fit.sum(axis=0)
    centred = ((n * fit - sums) / n).astype(float)
    cov = centred.T @ centred / n
    values, along = np.linalg.eigh(cov)
    values, along = values[::-1], along[:, ::-1].T
    count = min(components, int((values > 1e-12 * values[0]).sum()))
    rows = {i: (int(((n * np.array(x, dtype=object) - sums) ** 2).sum()), ((n * np.array(x, dtype=object) - sums) / n).astype(float)) for i, x in whole}
    return n, rows, values[:count], along[:count], np.trace(cov)


def check_whitened(frame, vectors, *, ties=False):
    got = defaultdict(dict)
    for r in frame.collect():
        got[r.vec_id][r.component] = r
    n, rows, values, along, trace = brute_whitened(vectors)
    assert set(got) == set(rows)
    signs = None
    for i, (deviation, centred) in rows.items():
        mine = [got[i][k + 1] for k in range(len(values))]
        assert len(got[i]) == len(values)
        assert {(r.n, r.deviation) for r in mine} == {(n, deviation)}
        assert all(r.identity_error <= 1e-9 for r in mine)
        assert np.allclose([r.explained for r in mine], values / trace, rtol=1e-9)
        expected = along @ centred / np.sqrt(values)
        found = np.array([r.whitened for r in mine])
        if ties:
            continue
        assert np.allclose(np.abs(found), np.abs(expected), rtol=1e-6, atol=1e-7)
        if np.abs(expected).min() > 1e-3:
            now = np.sign(found * expected)
            assert signs is None or (now == signs).all()
            signs = now


def vector_frame(spark, vectors):
    return spark.createDataFrame([(i, v, 0, 1.0) for i, v in vectors], "vec_id long, embedding array<float>, n int, x double").repartition(3)


def test_whitening_equals_eigenvectors(spark):
    rng = np.random.default_rng(3)
    turn = rng.normal(size=(24, 24))
    data = rng.normal(size=(300, 24)) * np.linspace(3, 0.2, 24) @ turn
    vectors = [(i, [float(np.float32(c)) for c in v]) for i, v in enumerate(data)]
    vectors += [(1000, vectors[0][1]), (1001, vectors[0][1]), (2000, None), (2001, [1.0] * 23 + [None]), (2002, [float("nan")] * 24), (2003, [float("inf")] * 24)]
    check_whitened(whitening.whiten(vector_frame(spark, vectors)), vectors)


def test_whitening_with_few_directions_and_ties(spark):
    flat = [(i, [float(i % 7), 2.0 * (i % 7), float(i % 3), 0.0, 5.0]) for i in range(60)]  # two directions in five
    check_whitened(whitening.whiten(vector_frame(spark, flat)), flat)
    cross = [(2 * k + s, [(8.0 if s else -8.0) if k == j else 0.0 for j in range(20)]) for k in range(20) for s in (0, 1)]
    check_whitened(whitening.whiten(vector_frame(spark, cross)), cross, ties=True)  # one deviation, twenty times


def test_whitening_of_equal_empty_and_mixed_vectors(spark):
    assert whitening.whiten(vector_frame(spark, [])).count() == 0
    assert whitening.whiten(vector_frame(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0]), (3, []), (4, None)])).count() == 0
    short = [(i, [float(i), float(i * i)]) for i in range(6)]
    long = [(10 + i, [float(i), float(i * i), float(-i)]) for i in range(6)]
    frame = whitening.whiten(vector_frame(spark, short + long + [(None, [9.0, 1.0])]))
    assert {(r.vec_id, r.component) for r in frame.collect()} >= {(i, 2) for i in (*range(6), *range(10, 16), None)}
    huge = [(1, [1e30, 0.0]), (2, [-1e30, 1.0]), (3, [0.0, 2.0])]
    assert {r.deviation for r in whitening.whiten(vector_frame(spark, huge)).collect()} >= {None}


def test_whitening_query_equals_eigenvectors(spark, small):
    vectors = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{small}/embeddings.parquet").collect()]
    check_whitened(QUERIES["op13_whitening"](spark, small), vectors)
