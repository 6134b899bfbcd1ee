import hashlib
import re

from lakelayer.llm.pii import KINDS, find_personal_data, masked

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        d = int(d) * (2 if i % 2 else 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def good(kind, value):
    digits = re.sub("[^0-9]", "", value)
    if kind == "ip":
        return all(int(p) <= 255 for p in value.split("."))
    if kind == "card":
        return 16 <= len(digits) <= 19 and luhn(digits)
    return 8 <= len(digits) <= 15 if kind == "phone" else True


def brute(text):
    return [(k, m.start(), m.end()) for k in KINDS
            for m in re.finditer(PATTERNS[k], text or "") if good(k, m.group())]


def base(row):
    return [(s.kind, s.start, s.stop) for s in row.spans if s.kind != "context"]


def test_base_spans_match_brute_force(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    found = {r.doc_id: base(r) for r in find_personal_data(docs).collect()}
    assert found == {i: brute(t) for i, t in texts.items()}
    assert sum(map(len, found.values())) > 20


EDGES = [
    None, "", "no one", "a@b.c_d@e.f", "x.y%z@h-1.example.com.", "foo@ bar@baz", "ééé me@site.org ✓ +1 (743) 555-3824 ü",
    "1.2.3.4.5.6.7.8", "256.1.1.1 0255.1.1.01 1.2.3", "4111 1111 1111 1111", "4111-1111-1111-1111 4111111111111112",
    "+49 (0)30.12-34567 +1 2 +12345678901234567", "9" * 5000, "1 " * 5000, "a." * 3000 + "@x" + ".y" * 3000,
    "ip 10.0.0.1, 10.0.0.1.", "@@@ a@b@c.d", "1.1.1.1@x.y", "𝒳𝒴 me@x.io",
]


def test_edges(spark):
    rows = [(i, t, "k") for i, t in enumerate(EDGES)] + [(3, EDGES[3], "k"), (None, "q@w.e", "k")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, key string")
    found = sorted(((r.doc_id, base(r)) for r in find_personal_data(docs).collect()), key=repr)
    assert found == sorted(((i, brute(t)) for i, t, _ in rows), key=repr)
    assert find_personal_data(docs.limit(0)).count() == 0


def test_context_finds_unseen_identifiers(spark):
    rows = [(i, f"please call hotline: +1 (555) 010-{1000 + i} now") for i in range(8)]
    rows += [(100, "words hotline: 555-AX-77 and the rest"), (101, "in the year 1999 of the"), (102, "hotline: 555-AX-77")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    more = {r.doc_id: [(s.start, s.stop) for s in r.spans if s.kind == "context"] for r in find_personal_data(docs).collect()}
    text = dict(rows)
    assert [text[100][a:b] for a, b in more[100]] == ["555-AX-77"]
    assert [text[102][a:b] for a, b in more[102]] == ["555-AX-77"]
    assert more[101] == [] and all(more[i] == [] for i in range(8))


def test_masked_keeps_columns_and_rows(spark):
    docs = spark.createDataFrame(
        [(1, "mail a@b.cd now", 7, "k"), (2, None, 8, "k"), (3, "plain", 9, "k"), (1, "mail a@b.cd now", 7, "k")],
        "doc_id long, text string, spans int, key string")
    out = sorted(masked(docs).collect(), key=repr)
    assert docs.columns == masked(docs).columns and len(out) == 4
    assert sorted((r.doc_id, r.text) for r in out if r.text) == [(1, "mail [email] now"), (1, "mail [email] now"), (3, "plain")]


def test_query_digest_and_plan(spark, sf_small):
    from lakelayer.llm.queries import op6_personal_data

    frame = op6_personal_data(spark, sf_small)
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_small}/documents.parquet").collect()}
    for r in frame.collect():
        spelled = ",".join(f"{k}:{a}:{b}" for k, a, b in brute(texts[r.doc_id]))
        assert r.base_sha256 == hashlib.sha256(spelled.encode()).hexdigest()
        assert r.spans.startswith(spelled)
    assert not re.search("Python|Pandas|Arrow", frame._jdf.queryExecution().toString())


def test_discovers_beside_cue_words_that_prose_uses_too(spark):
    import random

    rng = random.Random(3)
    prose = ["w" + chr(97 + i // 26) + chr(97 + i % 26) for i in range(300)] + ["call", "desk", "the"] * 3
    long_cue = "c" * 60 + ":"
    rows, unseen = [], {}

    def add(*middle):
        text = [rng.choice(prose) for _ in range(rng.randint(20, 40))]
        at = rng.randint(1, len(text) - 1)
        rows.append((len(rows), " ".join([*text[:at], *middle, *text[at:]])))

    for i in range(4000):
        add()
        if i % 8 == 0:
            add("call", "desk", f"+1 (555) 01{i % 10}-{1000 + i}")
        if i % 100 == 0:
            unseen[len(rows)] = f"QX-{i:05d}-ZW"
            add("call", "desk", unseen[len(rows)])
        if i % 20 == 0:
            add(f"u{i}@mail{i}.org")  # at any place: no pattern
        if i % 10 == 0:
            add(f"{1000 + i}x")  # an identifier-like token at any place: to be left alone
        if i % 40 == 0:
            add(long_cue)
            add(long_cue, f"+1 (555) 77{i % 10}-{1000 + i}")
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    texts = dict(rows)
    found = {(r.doc_id, texts[r.doc_id][s.start:s.stop]) for r in find_personal_data(docs).collect()
             for s in r.spans if s.kind == "context"}
    wanted = set(unseen.items())
    assert len(found & wanted) >= 0.95 * len(wanted)
    # The others are tokens that stand after a cue word by chance.
    assert len(found - wanted) <= 0.15 * len(found)
    assert all(re.search(r"\b(call|desk) " + re.escape(token), texts[i]) for i, token in found)


def test_words_of_any_length_are_neighbours(spark):
    from pyspark.sql import functions as F

    from lakelayer.llm.pii import first_word, last_words

    texts = ["", "a", " a ", "b a", "c b a\n", "x" * 100 + " y", "y " + "x" * 100, "b" + " " * 90 + "a" + " " * 90,
             "q " + "w" * 60 + " " * 60 + "v" * 60 + "  ", " " * 200, "a" * 200, "one two  three " * 20]
    df = spark.createDataFrame([(t,) for t in texts], "g string")
    last, before = last_words(F.col("g"))
    for g, a, b, c in df.select("g", last, before, first_word(F.col("g"))).collect():
        own = g.split()
        assert (a, b, c) == (own[-1] if own else "", own[-2] if len(own) > 1 else "", own[0] if own else "")
