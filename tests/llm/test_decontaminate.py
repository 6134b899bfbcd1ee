import hashlib
import re

import pytest

from lakelayer.llm.decontaminate import scan

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return WORD.findall(low)


def brute(docs, items, span=13):
    windows = {}
    for item, text in items:
        own = words(text)
        n = min(span, len(own))
        for i in range(len(own) - n + 1 if n else 0):
            windows.setdefault(tuple(own[i:i + n]), set()).add(str(item))
    out = []
    for doc_id, text in docs:
        own, hit, met = words(text), set(), set()
        for n in {len(w) for w in windows}:
            for i in range(len(own) - n + 1):
                found = windows.get(tuple(own[i:i + n]))
                if found:
                    hit.update(range(i, i + n))
                    met |= found
        out.append((doc_id, len(own), len(hit), sorted(met), bool(hit) and 20 * len(hit) >= len(own)))
    return out


def rows(df):
    return sorted(((r.doc_id, r.n_words, r.n_hit, list(r["items"]), r.contaminated) for r in df.collect()), key=repr)


def test_matches_brute_force_on_tables(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    items = spark.read.parquet(f"{sf_small}/benchmark.parquet")
    own = [(r.doc_id, r.text) for r in docs.collect()]
    tests = [(r.item_id, r.text) for r in items.collect()]
    expected = sorted(brute(own, tests), key=repr)
    assert rows(scan(docs, items)) == expected
    assert any(r[2] for r in expected)


ITEM = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen"


@pytest.mark.parametrize("bound", [0, 4_000_000])
def test_edges(spark, bound):
    docs = [
        (1, None), (2, ""), (3, " ... "), (4, ITEM.upper()), (4, ITEM.upper()), (5, ITEM + " x " + ITEM),
        (6, "a b"), (7, "a b a b a"), (None, "zz a-b"), (8, "w " * 400 + ITEM), (9, "w " * 100 + ITEM),
        (10, "two three four five six seven eight nine ten eleven twelve thirteen"), (11, "É" + ITEM),
    ]
    items = [(1, ITEM), (2, ITEM), (3, "A B"), (4, ""), (5, None), (6, "é")]
    frame = spark.createDataFrame([(i, t, "clash", 1) for i, t in docs], "doc_id long, text string, hits string, key int")
    tests = spark.createDataFrame([(i, t, 0) for i, t in items], "item_id long, text string, hash int")
    assert rows(scan(frame, tests, most_broadcast=bound)) == sorted(brute(docs, items), key=repr)


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    items = spark.createDataFrame([], "item_id long, text string")
    assert rows(scan(docs, items)) == [(1, 2, 0, [], False)]
    assert rows(scan(docs.limit(0), spark.createDataFrame([(1, "a")], "item_id long, text string"))) == []


def test_query_digest(spark, sf_small):
    from lakelayer.llm.queries import op7_decontaminate

    found = op7_decontaminate(spark, sf_small).where("n_hit = 0").first()
    assert found.items_sha256 == hashlib.sha256(b"").hexdigest() and found.n_items == 0


def test_no_python_on_the_main_path(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    plan = scan(docs, spark.read.parquet(f"{sf_small}/benchmark.parquet"))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_without_spans_removes_the_words_hit(spark):
    from lakelayer.llm.decontaminate import without_spans

    items = spark.createDataFrame([(1, ITEM), (2, "A B")], "item_id long, text string")
    docs = [(1, None, "x"), (2, "", "x"), (3, "Left, " + ITEM.upper() + "; right.", "x"), (3, "Left, " + ITEM.upper() + "; right.", "x"),
            (4, "a-b (a b) c é", "y"), (5, "nothing here...", "y"), (6, ITEM, "z"), (None, "so: a b!", "z")]
    frame = spark.createDataFrame(docs, "doc_id long, text string, covered string")
    out = without_spans(frame, items)
    assert out.columns == frame.columns
    text = {1: None, 2: "", 3: "Left; right.", 4: ") c é", 5: "nothing here...", 6: "", None: "so!"}
    assert sorted(map(tuple, out.collect()), key=repr) == sorted(((i, text[i], c) for i, _, c in docs), key=repr)
    assert without_spans(frame.limit(0), items).count() == 0
    assert sorted(map(tuple, without_spans(frame, items.limit(0)).collect()), key=repr) == sorted(docs, key=repr)


def test_without_spans_on_tables(spark, sf_small):
    from lakelayer.llm.decontaminate import without_spans

    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    items = spark.read.parquet(f"{sf_small}/benchmark.parquet")
    covered = {r.doc_id: [tuple(c) for c in r.covered] for r in scan(docs, items).collect()}
    left = {r.doc_id: r.text for r in without_spans(docs, items).select("doc_id", "text").collect()}
    assert any(covered.values())
    for r in docs.collect():
        own = words(r.text)
        kept = [w for i, w in enumerate(own) if not any(a <= i < b for a, b in covered[r.doc_id])]
        assert words(left[r.doc_id]) == kept
