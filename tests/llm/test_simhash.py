import random

import numpy as np
import pytest

from lakelayer.llm import simhash
from lakelayer.llm.simhash import FIVES, TRIPLES, fingerprint, fingerprint_groups, index, links, mask, shingle_hashes
from lakelayer.llm.tiles import local_roots, tiled


def brute_print(text):
    import xxhash

    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or ([b" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s, seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute(rows):
    prints = [brute_print(t) for _, t in rows]
    root = components(prints)
    least = {}
    for (doc_id, _), r in zip(rows, root):
        if doc_id is not None:
            least[r] = min(least.get(r, doc_id), doc_id)
    return sorted(((d, f"{p:016x}", least.get(r)) for (d, _), p, r in zip(rows, prints, root)), key=repr)


def components(prints):
    root = list(range(len(prints)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(prints):
        for j in range(i):
            if (a ^ prints[j]).bit_count() <= 3:
                root[find(i)] = find(j)
    return [find(i) for i in range(len(prints))]


def got(df):
    return sorted(((r.doc_id, r.fingerprint, r.component_id) for r in df.collect()), key=repr)


def corpus(seed):
    rng = random.Random(seed)
    rows = []
    for group in range(12):
        base = [f"w{rng.randrange(3000)}" for _ in range(300)]
        for _ in range(rng.randrange(1, 25)):
            words = list(base)
            for _ in range(rng.randrange(0, 4)):
                words[rng.randrange(len(words))] = f"N{rng.randrange(10**6)}"
            rows.append(" ".join(words))
    rows += [None, "", " \t\r\n\x0b\x0c", "one", "ONE", "two words", "Two\x0bwords", "three word text", "a b c", "ÉTÉ x y", "été x y"]
    rng.shuffle(rows)
    return [(i, t) for i, t in enumerate(rows)] + [(3, rows[3]), (None, rows[4]), (None, "nowhere else at all")]


def test_matches_brute_force(spark):
    rows = corpus(2)
    want = brute(rows)
    assert len({c for _, _, c in want}) < len({p for _, p, _ in want})  # different prints link
    df = spark.createDataFrame([(d, t, 1, "x") for d, t in rows], "doc_id long, text string, print int, bytes string")
    assert got(fingerprint_groups(df)) == want


def test_fingerprints_are_spark_hashes(spark):
    text = "Some words that make three word shingles , with ümläute too"
    words = text.lower().split()
    rows = [(" ".join(words[i:i + 3]),) for i in range(len(words) - 2)]
    native = {r[0] % 2**64 for r in spark.createDataFrame(rows, "s string").selectExpr("xxhash64(s)").collect()}
    assert {int(h) for part in shingle_hashes(text) for h in part} == native


def test_empty_table_and_texts_without_words(spark):
    assert fingerprint_groups(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    df = spark.createDataFrame([(5, None), (3, ""), (9, " \n")], "doc_id long, text string")
    assert got(fingerprint_groups(df)) == [(3, "0" * 16, 3), (5, "0" * 16, 3), (9, "0" * 16, 3)]


def test_long_texts_are_read_in_pieces(monkeypatch):
    rng = random.Random(8)
    text = "  ".join(f"Wort{rng.randrange(500)}" for _ in range(4000))
    want = brute_print(text)
    assert fingerprint(text) % 2**64 == want
    monkeypatch.setattr(simhash, "PIECE_BYTES", 5)
    assert fingerprint(text) % 2**64 == want
    assert fingerprint("one  two") % 2**64 == brute_print("one two")


@pytest.mark.parametrize("seed", range(3))
def test_positions_cover_every_pair(seed):
    rng = random.Random(seed)
    for _ in range(300):
        differ = {rng.randrange(8) for _ in range(3)}
        shared = set(range(8)) - differ
        assert any(set(t) <= shared for t in TRIPLES)
        for triple, fives in zip(TRIPLES, FIVES):
            assert not set(triple) <= shared or any(set(f) <= shared for f in fives)
    assert mask((0, 7)) == np.uint64(0xFF000000000000FF).astype(np.int64)


def test_hot_lists_keep_every_link(spark, monkeypatch):
    rng = random.Random(4)
    hub = 0x0123456789ABCDEF
    prints = {hub}
    while len(prints) < 300:  # a third within few bits of one fingerprint, others with shared bytes
        p = rng.choice(sorted(prints)[:100])
        prints.add(p ^ (1 << rng.randrange(24)) if len(prints) < 100 else p ^ rng.getrandbits(64) & 0xFFFF0000FFFF0000)
    prints = sorted(prints)
    root = components(prints)
    want = {frozenset(p for p, r in zip(prints, root) if r == x) for x in set(root)}
    signed = [(int(np.uint64(p).astype(np.int64)),) for p in prints]
    df = spark.createDataFrame(signed, "print long")
    monkeypatch.setattr(simhash, "tiled", lambda rows, keys, member: tiled(rows, keys, member, 10))
    for long in (5, 40, 10_000):
        edges = [(a % 2**64, b % 2**64) for a, b in links(df, long).collect()]
        place = {p: i for i, p in enumerate(prints)}
        left, right = (np.array([place[e[k]] for e in edges], np.int64) for k in (0, 1))
        roots = local_roots(len(prints), left, right)
        assert {frozenset(p for p, r in zip(prints, roots) if r == x) for x in set(roots.tolist())} == want
    assert index(df, 5).where("positions >= 8").count() > 0
    assert index(df).where("positions >= 8").count() == 0


def test_local_roots():
    assert local_roots(6, np.array([5, 4, 2]), np.array([4, 1, 0])).tolist() == [0, 1, 0, 3, 1, 1]
    assert local_roots(3, np.zeros(0, np.int64), np.zeros(0, np.int64)).tolist() == [0, 1, 2]
