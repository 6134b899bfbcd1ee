import random
from collections import defaultdict
from math import comb

import numpy as np
import pytest

from lakelayer.llm import jaccard
from lakelayer.llm.jaccard import LARGEST_LIGHT, MEET, boundary, link_groups, list_entries, needed, one_per_group, subset_keys, subsets_of


def brute(rows, k, num, den):
    sets = []
    for _, t in rows:
        w = (t or "").encode().lower().split()
        sets.append(set(zip(*(w[j:] for j in range(k)))) if len(w) >= k else ({tuple(w)} if w else set()))
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if a and sets[j] and den * both >= num * len(a | sets[j]):
                parent[find(i)] = find(j)
    least = defaultdict(list)
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[find(i)].append(doc_id)
    return [(d, len(s), min(least[find(i)], default=None) if s else d) for i, ((d, _), s) in enumerate(zip(rows, sets))]


def got(df):
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in df.collect()), key=repr)


def changed(words, n, rng):
    out = list(words)
    for _ in range(n):
        out[rng.randrange(len(out))] = f"new{rng.randrange(10**6)}"
    return out


def corpus(seed):
    rng = random.Random(seed)
    base = [f"w{rng.randrange(400)}" for _ in range(200)]
    rows = [" ".join(changed(base, rng.randrange(6), rng)) for _ in range(90)]  # one large group of near copies
    rows += [" ".join(base)] * 5
    shared = " ".join(f"s{i}" for i in range(60))
    rows += [shared + " " + " ".join(f"u{rng.randrange(10**6)}" for _ in range(rng.randrange(5, 60))) for _ in range(40)]
    for n in (1, 2, 3, 4, 9, 10, 11, 12, 13, 14, 19, 20, 21, 22, 25, 30, 40):  # small sets with near copies
        own = [f"v{rng.randrange(10**6)}" for _ in range(n)]
        rows += [" ".join(own), " ".join(own[:-1]), " ".join([*own, "end"]), " ".join(["x", *own]), " ".join(own).upper()]
    rows += [None, "", " \t\n", "the " * 500, "the " * 700]
    rng.shuffle(rows)
    return [(i + 1, t) for i, t in enumerate(rows)] + [(3, rows[2]), (None, rows[5]), (None, "alone in the world")]


@pytest.mark.parametrize("k,num,den,short,light,long", [
    (3, 9, 10, 32, None, 8), (5, 4, 5, 8, None, 8), (3, 9, 10, 4, 30, 8), (3, 9, 10, 3, None, 40)])
def test_matches_brute_force(spark, monkeypatch, k, num, den, short, light, long):
    monkeypatch.setattr(jaccard, "SHORT", short)
    monkeypatch.setattr(jaccard, "LONG_COUNT", long)
    if light:
        monkeypatch.setattr(jaccard, "boundary", lambda *_: light)
    rows = corpus(k)
    docs = spark.createDataFrame([(i, t, 1, "c") for i, t in rows], "doc_id long, text string, cls int, key string")
    expected = sorted(brute(rows, k, num, den), key=repr)
    assert got(link_groups(docs, k, num, den)) == expected


def test_likely_pairs_lose_no_link_and_spare_others(spark):
    """Sets of 40 shingles, up to 32 of them replaced: all links stay, most other pairs go."""
    rng = np.random.default_rng(4)
    sets, rows = {}, []
    for cls in range(300):
        own = np.random.default_rng(cls // 10).integers(0, 2**63, 40).astype(np.uint64)
        own[rng.permutation(40)[:rng.integers(0, 33)]] = 0
        own[own == 0] = rng.integers(0, 2**63, (own == 0).sum())
        sets[cls] = own = np.unique(own)
        n = len(own)
        entries, _ = list_entries(own, n - -(-9 * n // 10) + MEET, own[:0], own[:0].astype(np.int64))
        rows += [(cls, n, entries.tolist())] * (1 + cls % 2)  # a class may be described by several tasks
    described = spark.createDataFrame(rows, "cls long, n long, entries array<long>")
    met = [(a, b) for a in sets for b in sets if a < b and a // 10 == b // 10]
    links = {p for p in met if 10 * len(np.intersect1d(*map(sets.get, p))) >= 9 * len(np.union1d(*map(sets.get, p)))}
    likely = jaccard._likely(spark.createDataFrame(met, "a long, b long"), described, 9, 10).collect()
    assert links and links <= {(r.a, r.b) for r in likely} and len(likely) == len({(r.a, r.b) for r in likely})
    assert len(likely) - len(links) < (len(met) - len(links)) / 2


def test_light_sets_meet_exactly_when_they_link():
    rng = np.random.default_rng(0)
    for n in range(4, 24):
        own = np.unique(rng.integers(0, 2**63, n).astype(np.uint64))
        for drop in range(0, 3):
            other = np.unique(np.concatenate((own[drop:], rng.integers(0, 2**63, 1).astype(np.uint64))))
            both, size = len(np.intersect1d(own, other)), len(np.union1d(own, other))
            a, b = ({*zip(*x)} if x[0] is not None else set() for x in (subset_keys(own, 9, 10, 40), subset_keys(other, 9, 10, 40)))
            meets = any((key, 1 - side) in b for key, side in a)
            assert meets == (10 * both >= 9 * size and size > both), (n, drop)


def test_needed_and_boundary():
    for a in range(1, 60):
        for b in range(a, 60):
            linked = [o for o in range(a + 1) if 10 * o >= 9 * (a + b - o)]
            assert (min(linked) if linked else a + 1) == min(needed(a, b, 9, 10), a + 1)
    assert subsets_of(5, 9, 10, 40) == []
    assert boundary({500: 1000, 12: 3}, 9, 10) == 2  # all bounds to 12 cost the same


def test_boundary_has_the_least_cost():
    """Subsets that light sets enumerate, and three times the list entries of heavy ones."""
    def cost(sizes, bound):
        subsets = sum(c * comb(n, size) for n, c in sizes.items() if n <= bound
                      for low, high, size in subsets_of(n, 9, 10, bound))
        heavy = -(-9 * (bound + 1) // 10)
        return subsets + 3 * sum(c * (n - -(-9 * n // 10) + MEET) for n, c in sizes.items() if n >= heavy)

    best = []
    for sizes in ({500: 10, 12: 300, 9: 50, 6: 1000}, {7: 400, 8: 300, 300: 5}, {n: 100 for n in range(1, 60)}):
        costs = {b: cost(sizes, b) for b in range(2, LARGEST_LIGHT + 1)}
        best.append(boundary(sizes, 9, 10))
        assert costs[best[-1]] == min(costs.values())
        assert best[-1] == min(b for b in costs if costs[b] == min(costs.values()))
    assert min(best) > 2


def test_one_per_group_keeps_columns(spark):
    long = " ".join(f"w{i}" for i in range(60))
    rows = [(2, long, "a", 1), (1, long + " end", "b", 1), (1, long + " end", "b", 1), (5, "other words entirely", "c", 1), (6, None, "d", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, key string, kept int")
    out = one_per_group(docs)
    assert out.columns == docs.columns and sorted(r.doc_id for r in out.collect()) == [1, 5, 6]
    assert one_per_group(docs.limit(0)).count() == 0
