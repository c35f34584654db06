"""SimHash components, near-copies and repeated passages against brute force."""

from __future__ import annotations

import random
import re
from collections import Counter
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash

from rillmart.llm import near_copies, simhash, suffix_dedup
from rillmart.llm.components import components
from rillmart.llm.queries import QUERIES
from tests.llm.conftest import DOCUMENT, ODD


def words(text):
    return re.findall(rb"[^\x20\x09-\x0d]+", (text or "").encode().lower())


def brute_print(text):
    found = words(text)
    if not found:
        return 0
    hashes = [xxhash.xxh64_intdigest(b" ".join(found[i : i + 3]), 42) for i in range(max(1, len(found) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def roots(nodes, linked):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in linked:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    return {n: find(n) for n in nodes}


def test_simhash_of_odd_texts(odd):
    got = sorted((r.doc_id or 0, r.fp % 2**64) for r in simhash.fingerprints(odd).collect())
    assert got == sorted((i or 0, brute_print(t)) for i, t in ODD)


def test_simhash_query_equals_brute_force(spark, small):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    prints = {i: brute_print(t) for i, t in texts.items()}
    linked = [(a, b) for a, b in combinations(prints, 2) if (prints[a] ^ prints[b]).bit_count() <= 3]
    expected = {(i, f"{prints[i]:016x}", r) for i, r in roots(prints, linked).items()}
    assert {tuple(r)[:3] for r in QUERIES["op5_simhash"](spark, small).collect()} == expected


def test_full_buckets_go_on_to_finer_blocks(spark, monkeypatch):
    monkeypatch.setattr(simhash, "BUCKET", 4)
    rng = random.Random(5)
    centre = rng.getrandbits(64)
    prints = [centre]
    for _ in range(60):
        bits = rng.sample(range(64), rng.choice([1, 2, 3, 5]))
        prints.append(rng.choice(prints) ^ sum(1 << b for b in bits))
    prints += [rng.getrandbits(64) for _ in range(40)]
    prints = sorted({p - (1 << 64) if p >> 63 else p for p in prints})
    fps = spark.createDataFrame([(p,) for p in prints], "fp long")
    got = roots(prints, [tuple(r) for r in simhash.links(fps).collect()])
    near = [(a, b) for a, b in combinations(prints, 2) if ((a ^ b) % 2**64).bit_count() <= 3]
    assert got == roots(prints, near)


def test_components_of_a_long_chain(spark):
    edges = [(k, k + 1) for k in range(1, 40)] + [(100, 101), (7, 7), (100, 101)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {k: 1 for k in range(1, 41)} | {100: 100, 101: 100}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_simhash_empty_and_odd(odd, empty):
    assert simhash.near_duplicates(empty).count() == 0
    got = [(r.doc_id, r.component_id) for r in simhash.near_duplicates(odd).collect()]
    assert len(got) == len(ODD)
    assert {c for i, c in got if i in (1, 2, 3)} == {1}
    assert {c for i, c in got if i in (8, 9)} == {8}


def _varied(rng, text, edits):
    out = text.split()
    for _ in range(edits):
        out[rng.randrange(len(out))] = f"w{rng.randrange(10**6)}"
    return " ".join(out)


def _similarity(a, b):
    sets = [{b" ".join(w[i : i + 5]) for i in range(max(1, len(w) - 4))} for w in (words(a), words(b))]
    return len(sets[0] & sets[1]) / len(sets[0] | sets[1])


def test_near_copies_of_known_similarity(spark, monkeypatch):
    monkeypatch.setattr(near_copies, "BUCKET", 8)  # large groups are compared in parts
    rng = random.Random(9)
    texts = [" ".join(f"w{rng.randrange(3000)}" for _ in range(rng.choice([40, 120, 700]))) for _ in range(40)]
    rows = list(enumerate(texts))
    for k, text in enumerate(texts[:12]):
        rows += [(100 + 10 * k + j, _varied(rng, text, len(text.split()) // 100 + j % 2)) for j in range(3)]
    rows += [(500 + j, _varied(rng, texts[13], 1)) for j in range(30)]
    rows.append((600, texts[20].upper()))
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], DOCUMENT)
    got = {r.doc_id: r.component_id for r in near_copies.near_copies(docs).collect()}
    sims = {(a[0], b[0]): _similarity(a[1], b[1]) for a, b in combinations(rows, 2)}
    sure = roots([i for i, _ in rows], [p for p, s in sims.items() if s >= 0.85])
    possible = roots([i for i, _ in rows], [p for p, s in sims.items() if s >= 0.65])
    assert all(got[i] == got[r] for i, r in sure.items())
    assert all(possible[i] == possible[r] for i, r in got.items())
    kept = {r.doc_id for r in near_copies.deduplicate(docs).collect()}
    assert kept == set(got.values())


def test_near_copies_odd_and_empty(odd, empty):
    kept = near_copies.deduplicate(odd)
    assert kept.columns == odd.columns
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 1, 4, 5, 6, 7, 8]
    assert near_copies.deduplicate(empty).count() == 0


def brute_repeats(rows):
    first, out = {}, {}
    for i, raw in sorted((i, (t or "").encode()) for i, t in rows if i is not None):
        gone = bytearray(len(raw))
        for k in range(len(raw) - 49):
            if first.setdefault(raw[k : k + 50], i) < i:
                gone[k : k + 50] = b"\1" * 50
        spans = [m.span() for m in re.finditer(b"\1+", bytes(gone))]
        out[i] = (len(raw), spans, bytes(b for b, g in zip(raw, gone) if not g))
    return out


def _check_repeats(spark, rows):
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], DOCUMENT).repartition(5)
    got = {
        r.doc_id: (r.n_bytes, [(s.begin, s.end) for s in r.spans], bytes(r.kept))
        for r in suffix_dedup.remove_repeats(docs).collect()
        if r.doc_id is not None
    }
    assert got == brute_repeats(rows)


def test_repeats_equal_brute_force(spark):
    rng = random.Random(2)
    passages = ["".join(rng.choice("abc é") for _ in range(rng.choice([49, 50, 51, 90, 400]))) for _ in range(12)]
    passages += ["For " * 60, "\x00" * 80, "ab" * 70]
    rows = []
    for i in range(60):
        parts = [rng.choice(passages) if rng.random() < 0.4 else "".join(rng.choice("xyz q") for _ in range(rng.randrange(90))) for _ in range(6)]
        rows.append((i * 3 - 50, "".join(parts)))
    rows += [(900, rows[0][1]), (901, None), (902, ""), (903, "short"), (None, rows[1][1])]
    _check_repeats(spark, rows)


def test_repeats_with_small_slices_and_a_hot_passage(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "STRETCH", 64)
    rng = random.Random(4)
    hot = "".join(rng.choice("abcdefg ") for _ in range(160))
    rows = [(i, f"{rng.random()} {hot} {rng.random()}") for i in range(200)]
    _check_repeats(spark, rows)


def test_repeats_empty_table(empty):
    assert suffix_dedup.remove_repeats(empty).count() == 0


def test_multikey_order_is_lexicographic():
    rng = np.random.default_rng(1)
    words = rng.integers(0, 3, (500, 4)).astype(np.uint64)
    got = [tuple(w) for w in words[suffix_dedup.multikey_order(words)].tolist()]
    assert got == sorted(map(tuple, words.tolist()))


def test_near_copies_are_verified_at_the_similarity(spark):
    rng = random.Random(3)

    def fresh(n):
        return [f"w{rng.randrange(10**9)}" for _ in range(n)]

    rows = []
    for k in range(400):
        n = rng.choice([8, 8, 8, 12, 16, 30, 60, 200])  # words, four more than shingles
        text = fresh(n)
        longer = text + fresh(rng.choice([(n - 4) // 4, (n - 4) // 4 + 1]))  # similarity 0.8 or a little more, or less
        if k % 2 and n > 30:
            longer = list(text)
            for _ in range(rng.randrange(1, 3 + n // 40)):
                longer[rng.randrange(n)] = fresh(1)[0]
        rows += [(2 * k, " ".join(text)), (2 * k + 1, " ".join(longer))]
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], DOCUMENT).repartition(5)
    got = {r.doc_id: r.component_id for r in near_copies.near_copies(docs).collect()}
    texts = dict(rows)
    alike = {k: _similarity(texts[2 * k], texts[2 * k + 1]) >= 0.8 for k in range(400)}
    linked = {k: got[2 * k + 1] == 2 * k for k in alike}
    assert min(Counter(alike.values()).values()) > 100
    assert not [k for k in alike if linked[k] and not alike[k]]
    assert sum(linked[k] for k in alike if alike[k]) >= 0.98 * sum(alike.values())


def test_pieces_of_a_long_text_hold_each_window_once(monkeypatch):
    rng = random.Random(9)
    texts = ["".join(rng.choice("ab c") for _ in range(n)) for n in (1000, 259, 249, 210, 49)]
    rows = pa.RecordBatch.from_pydict({"doc_id": list(range(len(texts))), "text": texts})

    def windows():
        found = []
        for k in range(len(texts)):
            for part, at in suffix_dedup.slices([rows.slice(k, 1)]):
                hashes = part.hashes(part.start, suffix_dedup.LENGTH).tolist()
                found += list(zip([k] * len(hashes), (part.start + at).tolist(), (part.anchor + at).tolist(), hashes))
        return found

    whole = windows()
    monkeypatch.setattr(suffix_dedup, "LONG_TEXT", 200)
    assert windows() == whole and len(whole) == sum(max(0, len(t) - 49) for t in texts)


def test_long_texts_lose_what_an_earlier_one_holds(spark):
    rng = random.Random(11)
    long = rng.randbytes(4_500_000).hex()  # nine million bytes
    rows = [(1, long), (2, "before " + long[:8_000_000] + " between " + long[4_194_300:4_194_400] + " after"), (3, long[100:160])]
    got = {
        r.doc_id: ([(s.begin, s.end) for s in r.spans], bytes(r.kept).decode())
        for r in suffix_dedup.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    }
    assert got[1] == ([], long) and got[3] == ([(0, 60)], "")
    spans, kept = got[2]
    assert spans == [(7, 8_000_007), (8_000_016, 8_000_116)] and kept == "before  between  after"
