import random
import zlib
from collections import Counter

import numpy as np

from lakelayer.llm import spelling
from lakelayer.llm.spelling import LISTS, group_variants, listed, near_words, single_edits, text_words
from lakelayer.llm.tiles import pairs_in_groups, tiled

ROWS = "doc_id long, text string, n long, word string, list string"


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    long, short = sorted((a, b), key=len, reverse=True)
    return len(long) == len(short) + 1 and any(long[:i] + long[i + 1:] == short for i in range(len(long)))


def counts(rows):
    n = Counter()
    for doc_id, text in rows:
        run = ""
        for ch in (text or "") + " ":
            if ch.isascii() and ch.isalpha() or "À" <= ch <= "ÿ":
                run += chr(ord(ch) + 32) if "A" <= ch <= "Z" else ch
            elif run:
                h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
                n[run[:h % len(run)] + run[h % len(run) + 1:] if h % 97 == 0 else run] += 1
                run = ""
    return {w: k for w, k in n.items() if len(w) >= 5 and k >= 3}


def brute(rows):
    n = counts(rows)
    near = {w: [x for x in n if x != w and one_edit(w, x)] for w in n}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda x: (-n[x], x), default=None)
        if best is not None and n[best] >= 2 * n[w]:
            form[w] = best

    def root(w):
        return root(form[w]) if w in form else w

    return {w: (form.get(w), root(w), n[w], len(near[w]), n.get(form.get(w))) for w in n}


def got(df):
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect()}


def corpus(seed):
    rng = random.Random(seed)
    base = ["harbour", "harvest", "garden", "grÖßer", "straße", "naïveté", "aabbaabb", "aaaaa", "étéété", "planetary"]
    rows = []
    for i in range(300):
        words = []
        for _ in range(60):
            w = rng.choice(base)
            for _ in range(rng.choice((0, 0, 0, 0, 1, 1, 2))):  # a chain of slips
                at = rng.randrange(len(w))
                w = rng.choice((w[:at] + w[at + 1:], w[:at] + rng.choice("abÿ") + w[at:], w[:at] + rng.choice("abÿ") + w[at + 1:]))
            words.append(rng.choice((w, w.upper(), w.title())))
        rows.append((i, rng.choice((" ", "\n", ", ", "1", "ł")).join(words)))
    return rows


def test_matches_brute_force(spark):
    rows = corpus(1)
    want = brute(rows)
    found = got(group_variants(spark.createDataFrame(rows, "doc_id long, text string")))
    assert found == want
    assert sum(f is not None for f, *_ in want.values()) > 50
    assert any(form != root for form, root, *_ in want.values() if form)


def test_edge_rows_and_clashing_columns(spark):
    rows = [(1, None, 1, "x", "y"), (2, "", 1, None, None), (None, "stones " * 3, 1, "x", "y"), (3, "Stone " * 8, 1, "x", "y"),
            (3, "Stone " * 8, 1, "x", "y"), (4, "abcd " * 9, 1, "x", "y"), (5, "é" * 5 + " 1 " + "É" * 5, 1, "x", "y"),
            (6, "long" * 5000 + " " + ("stoné " * 30_000), 1, "x", "y"), (7, ("x" * 3000 + "\t") * 3 + ("x" * 3001 + "\n") * 7, 1, "x", "y")]
    plain = [(r[0], r[1]) for r in rows]
    want = brute(plain)
    assert {"x" * 3000, "x" * 3001, "stone", "stoné"} <= set(want)
    assert got(group_variants(spark.createDataFrame(rows, ROWS))) == want


def test_empty_tables(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    out = group_variants(df)
    assert out.columns == ["word", "form", "root", "n", "n_near", "form_n"] and out.count() == 0
    assert group_variants(spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string")).count() == 0


def test_long_texts_are_counted_in_pieces():
    rng = random.Random(3)
    text = " ".join(rng.choice(("harbour", "HARBOR", "été", "garden")) for _ in range(5000))
    whole = sorted(text_words("7", text))
    size, spelling.PIECE_BYTES = spelling.PIECE_BYTES, 64
    try:
        assert sorted(Counter(dict(text_words("7", text))).items()) == whole
        assert b"".join(spelling.pieces(b"a bc  def g", 2)) == b"a bc  def g"
    finally:
        spelling.PIECE_BYTES = size


def test_stretches_find_every_edit_once():
    rng = random.Random(5)
    words = sorted({"".join(rng.choice("ab") for _ in range(rng.randrange(5, 9))) for _ in range(250)})
    latin = [w.encode("latin-1") for w in words]
    length = np.array([len(w) for w in words])
    a, b = (x.astype(np.int64) for x in np.triu_indices(len(words), 1))
    close = np.abs(length[a] - length[b]) <= 1
    a, b = a[close], b[close]
    found = np.zeros(len(a), int)
    for part in range(spelling.PARTS):
        span = np.zeros(len(words), np.int64)
        for i, (x, y) in enumerate(zip(a.tolist(), b.tolist())):  # the span belongs to the pair's list
            span[[x, y]] = max(length[x], length[y])
            found[i] += single_edits(latin, length, a[i:i + 1], b[i:i + 1], span, np.full(len(words), part))[0]
    assert found.tolist() == [int(one_edit(words[x], words[y])) for x, y in zip(a.tolist(), b.tolist())]


def test_hot_lists_are_cut_into_tiles(spark, monkeypatch):
    words = [(f"prefix{a}{b}ending", 3 + (ord(a) + ord(b)) % 5) for a in "abcdefghij" for b in "abcdefghij"]
    df = spark.createDataFrame(words, "word string, n long")
    want = {r.word: (r.n_near, tuple(r.best)) for r in near_words(df).collect()}
    assert all(n == 18 for n, _ in want.values())
    monkeypatch.setattr(spelling, "tiled", lambda rows, keys, member: tiled(rows, keys, member, 7))
    assert {r.word: (r.n_near, tuple(r.best)) for r in near_words(df).collect()} == want
    cut = tiled(listed(df), LISTS, "word", 7)
    sizes = [r["count"] for r in cut.groupBy(*LISTS, "low", "high").count().collect()]
    assert cut.where("high > 0").count() and max(sizes) < 50


def test_pairs_of_groups():
    starts, tile = np.array([0, 3, 4, 8]), np.array([0, 0, 0, 0, 0, 1, 0, 1])
    within = np.array([True] * 4 + [False] * 4)
    pairs = {(int(x), int(y)) for left, right in pairs_in_groups(starts, tile, within) for x, y in zip(left, right)}
    assert pairs == {(0, 1), (0, 2), (1, 2), (4, 5), (4, 7), (5, 6), (6, 7)}
