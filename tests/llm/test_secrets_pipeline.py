import hashlib
import random
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from lakelayer.llm.secret_scan import (WIDTH, Network, _findings, base_spans, candidates, characters, find_secrets,
                                       pieces, train, train_on, windows)

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)


def brute(text):
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    return [(s, ["assign", "access", "hex"][k], e) for s, k, e in sorted(out)]


EDGES = [
    "", "token = \"11acdfb36bb72224148e6160f674b4be45601bff\"", "PASSWORD: hunter2hunter2", "api_key='short'", "ApiKey = abcdefgh",
    "secret token=12345678", "AKIA" + "A1" * 6, "AKIAAKIAAKIAAKIAB xAKIA123", "f" * 31, "f" * 32, "0" * 5000, "é token:  ✓ token: éabcdefgh",
    "ſecret=abcdefgh toKen=abcdefgh", "password=\npassword = abcd.efgh", "tokentoken=aaaaaaaa=bbbb", "deadbeef" * 4 + "G" + "cafe" * 9,
]


def test_base_spans_match_brute_force(spark, sf_small):
    texts = EDGES + [r.text for r in spark.read.parquet(f"{sf_small}/documents.parquet").collect()]
    assert [base_spans(t) for t in texts] == [brute(t) for t in texts]
    assert sum(map(len, map(brute, texts))) > 10


def test_query_keeps_base_and_digest(spark):
    from lakelayer.llm.queries import op3_secret_scan

    sf = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    for r in op3_secret_scan(spark, sf).collect():
        own = [f"{k}:{a}:{b}" for a, k, b in brute(texts[r.doc_id])]
        assert r.base_sha256 == hashlib.sha256(",".join(own).encode()).hexdigest()
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(x.startswith(k) for x in own) for k in ("assign", "access", "hex"))
        assert [x for x in r.spans.split(",") if x and not x.startswith("network")] == own


def made_up(rng, n):
    """Secrets after telling words (1), and other tokens of the same length (0)."""
    rows = []
    for _ in range(n):
        key = "".join(rng.choice("0123456789abcdefABCDEF") for _ in range(24))
        rows.append((f"the config sets credential = {key} for login", key, 1))
        plain = "".join(rng.choice("aeioulnrst") for _ in range(20)) + str(rng.randrange(10))
        rows.append((f"and then the {plain} went over the hill", plain, 0))
    return rows


def test_network_learns_and_keeps_the_wanted_recall():
    rng = random.Random(4)
    rows = made_up(rng, 400)
    codes = np.array([characters(t, t.index(k), t.index(k) + len(k)) for t, k, _ in rows])
    labels = np.array([y for *_, y in rows], dtype=float)
    net = train(codes, labels, recall=0.95)
    fresh = made_up(rng, 100)
    scores = net.scores(np.array([characters(t, t.index(k), t.index(k) + len(k)) for t, k, _ in fresh]))
    truth = np.array([y for *_, y in fresh])
    assert (scores[truth == 1] >= net.threshold).mean() >= 0.9 and (scores[truth == 0] >= net.threshold).mean() <= 0.05


def test_gradients_match_differences():
    rng = np.random.default_rng(0)
    net, codes = Network.fresh(rng), rng.integers(0, 98, (4, WIDTH))
    labels, weights = np.array([0.0, 1, 1, 0]), np.ones(4)

    def loss():
        z = net.logits(codes)
        return float(np.mean(np.log1p(np.exp(z)) - labels * z))

    for p, g in zip((net.embed, net.filters, net.bias, net.out), net.gradients(codes, labels, weights)):
        at = np.unravel_index(np.argmax(np.abs(g)), g.shape)
        p[at] += 1e-5
        up = loss()
        p[at] -= 2e-5
        down = loss()
        p[at] += 1e-5
        assert abs((up - down) / 2e-5 - g[at]) < 1e-4


def test_scan_edges(spark):
    rows = [(i, t, "x") for i, t in enumerate(EDGES)] + [(None, None, "x"), (2, EDGES[2], "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, spans string")
    net = train_on(docs)
    out = find_secrets(docs, net).collect()
    assert len(out) == len(rows)
    for r in out:
        own = [(s.start, s.kind, s.stop) for s in r.spans if s.kind != "network"]
        assert own == (brute(EDGES[r.doc_id]) if r.doc_id is not None else [])
    assert find_secrets(docs.limit(0)).count() == 0
    assert find_secrets(spark.createDataFrame([(1, "no secrets a1b2c3d4e5f6g7h8")], "doc_id long, text string")).first().spans == []


def test_every_value_is_a_candidate_and_read_whole():
    texts = ["pwd: hunter2x.", "key qwertzuiopasdf and 4711081512 or a.b_c-d/e=f", "x" * 95, "token=abcdefgh pwd=zyxwvuts", "é\n ab"]
    found = [[t[a:b] for a, b in candidates(t, base_spans(t))] for t in texts]
    assert found == [["hunter2x"], ["qwertzuiopasdf", "4711081512", "a.b_c-d/e=f"], ["x" * 95], ["pwd=zyxwvuts"], []]
    assert pieces(3, 98) == [(3, 43), (23, 63), (43, 83), (58, 98)] and pieces(0, 40) == [(0, 40)]
    for t in texts:
        spans = [(0, min(len(t), 40)), (len(t) // 2, len(t) // 2 + 2)]
        assert (windows(t, spans) == [characters(t, a, b) for a, b in spans]).all()


def test_unlabelled_tokens_are_no_negatives():
    texts = ["something ordinary token=abcd1234efgh", "something else ordinary unknown9secret77", "unknown9secret77 something"]
    out = next(_findings(iter([pa.RecordBatch.from_pydict({"text": texts})])))
    rows = [(bytes(c)[24:64].rstrip(b"\x61"), y) for c, y in zip(out.column("codes").to_pylist(), out.column("label").to_pylist())]
    spelled = {("".join(chr(x + 32) for x in c), y) for c, y in rows}
    assert spelled == {("something", 0), ("abcd1234efgh", 1)}


def test_pipeline_stages(spark):
    import corpus_pipeline as p
    from lakelayer.llm.quality_rules import RULES, Document, cascade
    from .test_decontaminate import brute as contaminated
    from .test_jaccard import brute as groups

    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    columns = docs.columns
    now = docs
    for name, stage in p.STAGES[:-1]:
        before = {r.doc_id: r for r in now.collect()}
        now = stage(spark, now, sf).cache()
        after = {r.doc_id: r for r in now.collect()}
        assert now.columns == columns and now.dtypes == docs.dtypes
        rows = [(i, r.text) for i, r in sorted(before.items())]
        if name == "quality_rules":
            assert set(after) == {i for i, t in rows if cascade(RULES, Document(t)) is None}
        elif name == "near_duplicates":
            assert set(after) == {i for i, n, least in groups(rows, 5, 4, 5) if n == 0 or i == least}
        elif name == "decontamination":
            assert set(after) == {r[0] for r in contaminated(rows, items) if not r[4]}
        else:
            assert set(after) == set(before) and all(r.n_chars == len(r.text) for r in after.values())
            assert now.where(F.col("text").rlike(r"[A-Za-z0-9]@[a-z0-9]+\.example")).count() == 0
        if name != "personal_data":
            assert all(after[i] == before[i] for i in after)
    last = p.STAGES[-1][1](spark, now, sf)
    assert {r.doc_id for r in last.collect()} == set(after)
    assert p.run(spark, sf).count() == last.count()


def test_library_works_without_the_subpackage(tmp_path):
    import os
    import shutil
    import subprocess
    import sys

    repo = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    shutil.copytree(f"{repo}/lakelayer", tmp_path / "lakelayer", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(f"{repo}/__spark_entry__.py", tmp_path)
    found = subprocess.run([sys.executable, "-c", "import __spark_entry__ as e; print(len(e.queries()), 'op1_pack_sequences' in e.queries())"],
                           cwd=tmp_path, capture_output=True, text=True)
    assert found.stdout.split()[-1] == "False" and int(found.stdout.split()[-2]) >= 39


def test_findings_of_all_documents_train(spark):
    from lakelayer.llm.secret_scan import LEFT, findings

    def text(i):
        key = hashlib.sha256(str(i).encode()).hexdigest()[:20]
        return f"letter{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}{chr(97 + i // 676)}longer wordinbetween token = {key} and afterwards {'x' * 100 if i == 7 else ''}"

    docs = spark.createDataFrame([(i, text(i % 4500)) for i in range(9000)], "doc_id long, text string").repartition(7, "doc_id")
    rows = findings(docs).collect()
    # Every value, and every word of several texts wherever they are: 4,000 of each were taken before.
    assert sum(r.label for r in rows) == 4500
    bodies = {bytes(r.codes)[LEFT:LEFT + 40] for r in rows if r.label == 0}
    assert len(bodies) == len(rows) - 4500 == 4500 + 2 + 1  # words of one's own, two common ones, and one window of a long one
    net = train_on(docs, epochs=2)
    again = train_on(docs.repartition(3), epochs=2)
    assert all(np.allclose(a, b) for a, b in zip(net.params(), again.params())) and abs(net.threshold - again.threshold) < 1e-6
    tokens = [(t, t.index("=") + 2) for t in map(text, range(4500, 4600))]
    scores = net.scores(np.array([characters(t, a, a + 20) for t, a in tokens]))
    assert (scores >= net.threshold).mean() > 0.85


def plain_logits(net, codes, batch=512):
    """Every step of every window, by one table per place."""
    e, steps, parts = net.embed.shape[1], WIDTH - net.span + 1, []
    tables = [(net.embed @ net.filters[j * e:(j + 1) * e]).astype(np.float32) for j in range(net.span)]
    for i in range(0, len(codes), batch):
        active = np.maximum(sum(t[codes[i:i + batch, j:j + steps]] for j, t in enumerate(tables)) + net.bias.astype(np.float32), 0)
        parts.append(np.concatenate((active.max(axis=1), active.mean(axis=1), np.ones((len(active), 1))), axis=1) @ net.out)
    return np.concatenate(parts)


def test_windows_are_scored_by_the_length_of_their_body():
    import time

    from lakelayer.llm.secret_scan import ALPHABET, BODY, LEFT, NOTHING

    rng = np.random.default_rng(3)
    for span in (1, 4, 5):
        net = Network.fresh(rng, span=span)
        net.bias[:] = rng.normal(size=len(net.bias))
        codes = rng.integers(0, ALPHABET, (12_000, WIDTH)).astype(np.uint8)  # NOTHING also stands among the characters
        length = np.where(np.arange(12_000) < 1200, np.arange(12_000) % (BODY + 1), 8 + np.arange(12_000) % 6)
        codes[:, LEFT:LEFT + BODY][np.arange(BODY) >= length[:, None]] = NOTHING
        codes[:200, :LEFT] = codes[100:300, LEFT + BODY:] = NOTHING
        assert np.allclose(net.logits(codes), net._forward(codes)[3], atol=1e-4)
        assert np.allclose(net.logits(codes.astype(np.int64)), plain_logits(net, codes), atol=1e-4)
        assert net.logits(codes[:0]).shape == (0,)
    used = []
    for score in (net.logits, lambda c: plain_logits(net, c)):
        at = time.process_time()
        score(codes)
        used.append(time.process_time() - at)
    assert 2 * used[0] < used[1]


def test_windows_of_many_texts_are_cut_at_once(monkeypatch):
    from lakelayer.llm import secret_scan

    texts = ["", "password = Tr0ub4dor&3 and more", "é\U0001f600 supercalifragilistic\nexpialidocious", "a\0b abcdefghij", "nothing here", "x" * 95]
    spans = [[p for a, b in candidates(t, base_spans(t)) for p in pieces(a, b)] for t in texts]
    brute = np.array([characters(t, a, b) for t, own in zip(texts, spans) for a, b in own])
    assert len(brute) > 6
    for chars in (1, 60, 500_000):
        monkeypatch.setattr(secret_scan, "AT_ONCE_CHARS", chars)
        assert (secret_scan.windows_of(texts, spans) == brute).all()
    assert secret_scan.windows_of([], []).shape == (0, WIDTH)
