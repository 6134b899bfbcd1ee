"""Property tests on random small frames (hypothesis), each against a brute-force model."""

from collections import Counter

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from lakelayer.functions.exprs import REASON_COL
from lakelayer.operators.conform import latest_per_key
from lakelayer.operators.merge import merge_upsert
from lakelayer.operators.quality import QualityRules, run_quality_gate

SETTINGS = settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))

ids = st.sampled_from(["a", "b", "c", "d", None])
texts = st.sampled_from(["1", "2.5", "x", "", " ", None, "N/A", "7"])
rows = st.lists(st.tuples(ids, texts, texts), min_size=0, max_size=25)


def _model_gate(data):
    counts = Counter(r[0] for r in data)
    out = []
    for k, q, p in data:
        tags = []
        if k is None or k.strip() == "" or q is None or q.strip() == "":
            tags.append("null_required_field")
        if q is not None and _not_number(q):
            tags.append("non_numeric_value")
        if counts[k] > 1:
            tags.append("duplicate_key")
        out.append((k, q, p, ",".join(tags) or None))
    return Counter(out)


def _not_number(s):
    try:
        float(s)
        return s.strip() == ""
    except ValueError:
        return True


@SETTINGS
@given(data=rows)
def test_gate_matches_model_and_partitions_input(spark, data):
    df = spark.createDataFrame(data, "k string, q string, p string")
    rules = QualityRules(("k", "q"), ("q",), ("k",))
    for method in ("aggregate", "window"):
        gate = run_quality_gate(df, rules, duplicate_method=method)
        got = Counter(tuple(r) for r in gate.tagged.select("k", "q", "p", REASON_COL).collect())
        assert got == _model_gate(data)
        assert gate.clean.count() + gate.quarantined.count() == len(data)


ship = st.lists(st.tuples(ids, st.integers(0, 3), st.sampled_from(["x", "y", None])), max_size=25)


@SETTINGS
@given(data=ship)
def test_latest_per_key_matches_sort_model(spark, data):
    df = spark.createDataFrame(data, "k string, d int, v string")
    got = sorted((tuple(r) for r in latest_per_key(df, ["k"], ["d"]).collect()), key=repr)
    best = {}
    for k, d, v in data:
        rank = ((d is not None, d), (v is not None, v))
        if k not in best or rank > best[k][0]:
            best[k] = (rank, (k, d, v))
    assert got == sorted((row for _, row in best.values()), key=repr)


tgt = st.lists(st.tuples(ids, st.integers(0, 9)), max_size=12)
src = st.lists(st.tuples(ids, st.integers(10, 19)), max_size=12)


@SETTINGS
@given(t=tgt, s=src)
def test_merge_matches_model_and_is_idempotent(spark, t, s):
    # Source keys must be unique among non-null keys.
    seen, s_unique = set(), []
    for k, v in s:
        if k is None or k not in seen:
            s_unique.append((k, v))
            seen.add(k)
    target = spark.createDataFrame(t, "k string, v int")
    source = spark.createDataFrame(s_unique, "k string, v int")
    once = merge_upsert(target, source, ["k"], ["v"])
    updates = {k: v for k, v in s_unique if k is not None}
    tkeys = {k for k, _ in t if k is not None}
    model = [(k, updates.get(k, v) if k is not None else v) for k, v in t]
    model += [(k, v) for k, v in s_unique if k is None or k not in tkeys]
    assert Counter(tuple(r) for r in once.collect()) == Counter(model)
    if all(k is not None for k, _ in s_unique):
        twice = merge_upsert(once, source, ["k"], ["v"])
        assert Counter(tuple(r) for r in twice.collect()) == Counter(model)
