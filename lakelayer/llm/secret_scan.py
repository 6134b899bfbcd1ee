"""Secrets in texts: fixed patterns, and a character convolutional network over every other candidate.

Three kinds have fixed patterns; their matches are always spans. Any other run
of at least 8 characters that a value may hold is a candidate. A small network
reads the candidate's characters, long ones in overlapping windows, and those
around it. It is trained on the labelled findings of all documents: values of the
fixed patterns, against words without digits that stand in several texts, each
word once; half of both without what stands around them. Other tokens may be
secrets that no pattern knows, so they are not training data. Tasks train on
their share of the findings with numpy, epoch by epoch, and go on from the mean
of all tasks (iterative parameter mixing, McDonald et al., 2010). Scores are
calibrated on all held-out findings, a quarter (logistic scaling), and the
threshold is the highest one that keeps the wanted recall there.
"""

from __future__ import annotations

import copy
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakelayer.llm.common import stage

KINDS = ["assign", "access", "hex"]
# The base patterns, and how long a match has to be.
ASSIGN = re.compile(r"""(?ai:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")  # the runs of at least 32
ASSIGN_HINTS = ("password", "passwd", "secret", "token", "apikey", "api_key")
CANDIDATE = re.compile(r"[A-Za-z0-9+/_.=-]{8,}")
DIGIT = re.compile("[0-9]")

LEFT, BODY, RIGHT = 24, 40, 8
WIDTH = LEFT + BODY + RIGHT
ALPHABET = 98  # printable ASCII, line break, anything else, nothing
NOTHING = ALPHABET - 1
AT_ONCE = 20_000  # windows scored together
AT_ONCE_CHARS = 500_000  # characters of texts whose windows are cut together
CODES = np.array([NOTHING, *[95 if c == 10 else c - 32 if 32 <= c < 127 else 96 for c in range(1, 128)]], dtype=np.uint8)
EPOCHS = 12
TRAINED = 400_000  # with more findings than EPOCHS passes make of it: fewer passes, one at least
TASK_FINDINGS = 50_000  # findings that one task trains on
GRID = 1000  # held-out logits are counted by thousandths
RECALL = 0.95


def base_spans(text: str) -> list[tuple[int, str, int]]:
    """(start, kind, stop) of the fixed patterns, by start, then kind as listed."""
    found = []
    low = text.lower()
    if any(hint in low for hint in ASSIGN_HINTS):
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[1]) >= 8]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 16]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return [(start, KINDS[kind], stop) for start, kind, stop in sorted(found)]


def candidates(text: str, base: list[tuple[int, str, int]]) -> list[tuple[int, int]]:
    """Tokens between the base spans, without the full stops at their end."""
    found, at = [], 0
    for start, stop in [*((a, b) for a, _, b in base), (len(text), len(text))]:
        if start > at:
            for m in CANDIDATE.finditer(text, at, start):
                first, end = m.span()
                if text[end - 1] == ".":
                    end = first + len(m[0].rstrip("."))
                if end - first >= 8:
                    found.append((first, end))
        at = max(at, stop)
    return found


def pieces(start: int, stop: int) -> list[tuple[int, int]]:
    """A span as windows of at most BODY characters, each half over the one before."""
    if stop - start <= BODY:
        return [(start, stop)]
    return [(a, a + BODY) for a in [*range(start, stop - BODY, BODY // 2), stop - BODY]]


def windows(text: str, spans: list[tuple[int, int]]) -> np.ndarray:
    """``characters`` of every span, as bytes."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")
    codes = np.full(len(points) + LEFT + WIDTH, NOTHING, dtype=np.uint8)
    codes[LEFT:LEFT + len(points)] = CODES[np.minimum(points, 127)]
    start, stop = np.array(spans, dtype=np.int64).reshape(-1, 2).T[:, :, None]
    body = np.arange(BODY)
    return np.concatenate((
        codes[start + np.arange(LEFT)], np.where(start + body < stop, codes[np.minimum(start + LEFT + body, len(codes) - 1)], NOTHING),
        codes[stop + LEFT + np.arange(RIGHT)]), axis=1).astype(np.uint8)


def windows_of(texts: list[str], spans: list[list[tuple[int, int]]]) -> np.ndarray:
    """``windows`` of every text's spans, text by text. Texts are joined with nothing between them, as far as a window reaches."""
    found, joined, asked, at = [np.zeros((0, WIDTH), np.uint8)], [], [], 0
    for i, (text, own) in enumerate(zip(texts, spans), 1):
        if own:
            asked += [(at + a, at + b) for a, b in own]
            joined.append(text)
            at += len(text) + LEFT
        if at >= AT_ONCE_CHARS or len(asked) >= AT_ONCE or i == len(texts):
            found.append(windows(("\0" * LEFT).join(joined), asked))
            joined, asked, at = [], [], 0
    return np.concatenate(found)


def characters(text: str, start: int, stop: int) -> np.ndarray:
    """Codes of the characters before, in and after a span, padded to WIDTH."""
    parts = (text[max(0, start - LEFT):start].rjust(LEFT, "\0"), text[start:min(stop, start + BODY)].ljust(BODY, "\0"),
             text[stop:stop + RIGHT].ljust(RIGHT, "\0"))
    codes = np.array([ord(c) for c in "".join(parts)])
    return np.where(codes == 0, 97, np.where(codes == 10, 95, np.where((codes >= 32) & (codes < 127), codes - 32, 96)))


@dataclass
class Network:
    """Embedding, one convolution, maximum and mean over the window, logistic output."""

    embed: np.ndarray  # ALPHABET x e
    filters: np.ndarray  # (k * e) x f
    bias: np.ndarray
    out: np.ndarray  # 2f + 1
    span: int = 5
    slope: float = 1.0
    shift: float = 0.0
    threshold: float = 0.5

    @classmethod
    def fresh(cls, rng: np.random.Generator, e: int = 8, f: int = 16, span: int = 5) -> Network:
        return cls(rng.normal(0, 0.3, (ALPHABET, e)), rng.normal(0, (2 / (span * e)) ** 0.5, (span * e, f)),
                   np.zeros(f), rng.normal(0, 0.1, 2 * f + 1), span)

    def params(self) -> tuple[np.ndarray, ...]:
        return self.embed, self.filters, self.bias, self.out

    def fresh_state(self) -> list[tuple[np.ndarray, np.ndarray]]:
        """Adam's means of the gradients and of their squares."""
        return [(np.zeros_like(p), np.zeros_like(p)) for p in self.params()]

    def _forward(self, codes: np.ndarray):
        x = self.embed[codes]
        windows = np.lib.stride_tricks.sliding_window_view(x, self.span, axis=1).transpose(0, 1, 3, 2)
        windows = windows.reshape(len(codes), WIDTH - self.span + 1, -1)
        active = np.maximum(windows @ self.filters + self.bias, 0)
        pooled = np.concatenate((active.max(axis=1), active.mean(axis=1), np.ones((len(codes), 1))), axis=1)
        return windows, active, pooled, pooled @ self.out

    def logits(self, codes: np.ndarray, batch: int = 1024) -> np.ndarray:
        # A table per place in the convolution, and one per pair of places, in place of a product for every window.
        # Windows go by the length of their body: of the steps that read nothing one is computed and counted for all.
        e, out = self.embed.shape[1], np.zeros(len(codes))
        tables = [(self.embed @ self.filters[j * e:(j + 1) * e]).astype(np.float32) for j in range(self.span)]
        tables[0] = tables[0] + self.bias.astype(np.float32)
        pairs = [(j, (tables[j][:, None] + tables[j + 1][None]).reshape(ALPHABET**2, -1)) for j in range(0, self.span - 1, 2)]
        last = tables[-1]  # read alone if the span is odd
        empty = np.maximum(sum(t[NOTHING] for t in tables), 0)
        codes = codes.astype(np.uint8, copy=False)
        read = codes[:, LEFT:LEFT + BODY] != NOTHING
        length = np.where(read.any(axis=1), BODY - read[:, ::-1].argmax(axis=1), 0)
        kept = np.minimum(-(-length // 4) * 4 + self.span, BODY)  # characters of the body that are read
        order = np.argsort(kept, kind="stable")
        for width in np.unique(kept):
            group = order[np.searchsorted(kept[order], width):np.searchsorted(kept[order], width, "right")]
            columns = np.concatenate((np.arange(LEFT + width), np.arange(LEFT + BODY, WIDTH)))
            steps, left_out = len(columns) - self.span + 1, BODY - width
            for i in range(0, len(group), batch):
                own = codes[group[i:i + batch]].T[columns].astype(np.intp)
                both = own[:-1] * ALPHABET + own[1:]
                top, total = np.zeros((2, own.shape[1], len(self.bias)), np.float32)
                for step in range(steps):
                    active = last.take(own[step + self.span - 1], axis=0) if self.span % 2 else np.zeros_like(top)
                    for j, t in pairs:
                        active += t.take(both[step + j], axis=0)
                    np.maximum(active, 0, out=active)
                    np.maximum(active, top, out=top)
                    total += active
                mean = (total + left_out * empty) / (steps + left_out)
                out[group[i:i + batch]] = np.concatenate((top, mean, np.ones((len(top), 1))), axis=1) @ self.out
        return out

    def scores(self, codes: np.ndarray) -> np.ndarray:
        """Calibrated probability of a secret."""
        return 1 / (1 + np.exp(-np.clip(self.slope * self.logits(codes) + self.shift, -50, 50)))

    def gradients(self, codes: np.ndarray, labels: np.ndarray, weights: np.ndarray) -> list[np.ndarray]:
        windows, active, pooled, logit = self._forward(codes)
        error = (1 / (1 + np.exp(-np.clip(logit, -50, 50))) - labels) * weights / len(codes)
        f, steps = self.filters.shape[1], active.shape[1]
        back = error[:, None] * self.out[None, :]
        grow = np.repeat(back[:, None, f:2 * f] / steps, steps, axis=1)
        top = active.argmax(axis=1)
        rows, cols = np.indices(top.shape)
        grow[rows, top, cols] += back[:, :f]
        grow = grow * (active > 0)
        flat = grow.reshape(-1, f)
        by_window = (grow @ self.filters.T).reshape(len(codes), steps, self.span, -1)
        by_place = np.zeros((len(codes), WIDTH, self.embed.shape[1]))
        for j in range(self.span):
            by_place[:, j:j + steps] += by_window[:, :, j]
        embed = np.zeros_like(self.embed)
        np.add.at(embed, codes, by_place)
        return [embed, windows.reshape(-1, windows.shape[2]).T @ flat, flat.sum(axis=0), pooled.T @ error]


def _epoch(net: Network, state: list, step: int, codes: np.ndarray, labels: np.ndarray, weights: np.ndarray,
           order: np.ndarray, batch: int) -> int:
    """One pass of Adam over the findings in ``order``; the number of steps so far."""
    for at in np.array_split(order, max(1, len(order) // batch)):
        step += 1
        for p, g, (m, v) in zip(net.params(), net.gradients(codes[at], labels[at], weights[at]), state):
            m[:] = 0.9 * m + 0.1 * g
            v[:] = 0.999 * v + 0.001 * g * g
            p -= 0.01 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return step


def _class_weights(labels: np.ndarray, share: float) -> np.ndarray:
    return np.where(labels == 1, 0.5 / max(share, 1e-3), 0.5 / max(1 - share, 1e-3))


def _calibrate(net: Network, logit: np.ndarray, truth: np.ndarray, times: np.ndarray, recall: float) -> None:
    """Scaling and threshold from held-out logits, each counted ``times``."""
    total = max(1.0, float(times.sum()))
    for _ in range(200):  # logistic scaling by gradient steps
        p = 1 / (1 + np.exp(-np.clip(net.slope * logit + net.shift, -50, 50)))
        net.slope -= 0.05 * float(((p - truth) * logit * times).sum()) / total
        net.shift -= 0.05 * float(((p - truth) * times).sum()) / total
    positive = truth == 1
    score = 1 / (1 + np.exp(-np.clip(net.slope * logit[positive] + net.shift, -50, 50)))
    order = np.argsort(score)
    upto = np.cumsum(times[positive][order])
    # The highest threshold at which at most (1 - recall) of the held-out secrets are missed.
    net.threshold = float(score[order][np.searchsorted(upto, int((1 - recall) * upto[-1]), "right")]) if len(upto) else 1.1


def train(codes: np.ndarray, labels: np.ndarray, seed: int = 5, epochs: int = EPOCHS, batch: int = 128,
          recall: float = RECALL) -> Network:
    """Adam on three quarters of the findings; scaling and threshold from the last quarter."""
    rng = np.random.default_rng(seed)
    net = Network.fresh(rng)
    if not labels.any() or labels.all():  # nothing to learn from: no score reaches the threshold
        net.threshold = 1.1
        return net
    order = rng.permutation(len(codes))
    held, used = order[:len(order) // 4], order[len(order) // 4:]
    weights = _class_weights(labels, labels[used].mean() if len(used) else 0.5)
    state, step = net.fresh_state(), 0
    for _ in range(epochs):
        step = _epoch(net, state, step, codes, labels, weights, rng.permutation(used), batch)
    _calibrate(net, net.logits(codes[held]), labels[held], np.ones(len(held)), recall)
    return net


def _findings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Labelled findings of a task: values of base spans (1), and words without digits that stand in several texts (0)."""
    for batch in batches:
        texts = [t or "" for t in batch.column("text").to_pylist()]
        bases = [base_spans(t) for t in texts]
        words, seen = [], Counter()
        for text, base in zip(texts, bases):
            own = [(a, b) for a, b in candidates(text, base) if not DIGIT.search(text, a, b)]
            words.append(own)
            seen.update({text[a:b].lower() for a, b in own})
        codes, labels = [np.zeros((0, WIDTH), np.uint8)], []
        for text, base, own in zip(texts, bases, words):
            values = []
            for a, kind, b in base:
                a = ASSIGN.match(text, a).start(1) if kind == "assign" else a
                values += pieces(a, b)[:2]
            plain = [p for i, (a, b) in enumerate(own) if i % 5 == 0 and seen[text[a:b].lower()] > 1 for p in pieces(a, b)[:2]]
            found = windows(text, values + plain)
            for i, (a, b) in enumerate(values + plain):
                if zlib.crc32(text[a:b].encode("utf-8", "surrogatepass")) % 2:  # without what stands around it
                    found[i, :LEFT], found[i, LEFT + BODY:] = NOTHING, NOTHING
            codes.append(found)
            labels += [1] * len(values) + [0] * len(plain)
        yield pa.RecordBatch.from_pydict({
            "codes": pa.array([c.tobytes() for c in np.concatenate(codes)], pa.binary()), "label": pa.array(labels, pa.int32())})


def _corpus_findings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Labelled findings of a task: windows of base values (1), and of each word without digits one, with its texts (0).

    ``body`` tells findings apart; of a word the window in the text of least hash counts.
    """
    for batch in batches:
        texts = [t or "" for t in batch.column("text").to_pylist()]
        words: dict[str, list] = {}
        values: list[list[tuple[int, int]]] = []
        for row, text in enumerate(texts):
            base, spans, own = base_spans(text), [], {}
            for a, kind, b in base:
                spans += pieces(ASSIGN.match(text, a).start(1) if kind == "assign" else a, b)
            values.append(spans)
            for a, b in candidates(text, base):
                word = text[a:b]
                if word.isalpha() or not DIGIT.search(word):
                    if b - a <= BODY:
                        own.setdefault(word.lower(), (a, b))
                    else:
                        for c, d in pieces(a, b):
                            own.setdefault(text[c:d].lower(), (c, d))
            place = zlib.crc32(text.encode("utf-8", "surrogatepass"))
            for word, span in own.items():
                was = words.get(word)
                if was is None:
                    words[word] = [1, place, row, span]
                else:
                    was[0] += 1
                    if place < was[1]:
                        was[1:] = place, row, span
        plain: list[list[tuple[int, int]]] = [[] for _ in texts]
        names: list[list[str]] = [[] for _ in texts]
        for word, (_, _, row, span) in words.items():
            plain[row].append(span)
            names[row].append(word)
        least = [words[w] for own in names for w in own]
        for label, spans in ((1, values), (0, plain)):
            codes = _half_alone(texts, spans)
            spelled = pa.Array.from_buffers(pa.binary(WIDTH), len(codes), [None, pa.py_buffer(np.ascontiguousarray(codes))]).cast(pa.binary())
            yield pa.RecordBatch.from_pydict({
                "label": pa.array(np.full(len(codes), label, np.int32)),
                "body": spelled if label else pa.array([w.encode() for own in names for w in own], pa.binary()),
                "texts": pa.array([1] * len(codes) if label else [x[0] for x in least], pa.int64()),
                "place": pa.array([0] * len(codes) if label else [x[1] for x in least], pa.int64()),
                "codes": spelled})


def _half_alone(texts: list[str], spans: list[list[tuple[int, int]]]) -> np.ndarray:
    """Windows of each text's spans, half of them (by hash) without what stands around them."""
    found = windows_of(texts, spans)
    alone = np.array([zlib.crc32(t[a:b].lower().encode("utf-8", "surrogatepass")) % 2 for t, own in zip(texts, spans) for a, b in own], bool)
    found[alone, :LEFT], found[alone, LEFT + BODY:] = NOTHING, NOTHING
    return found


def findings(docs: DataFrame) -> DataFrame:
    """Distinct labelled findings of all rows of ``docs`` (text): codes, label."""
    found = docs.select("text").mapInArrow(_corpus_findings, "label int, body binary, texts long, place long, codes binary")
    found = found.groupBy("label", "body").agg(F.sum("texts").alias("texts"), F.min(F.struct("place", "codes")).alias("least"))
    return found.where("label = 1 or texts > 1").select(F.col("least.codes").alias("codes"), "label")


def _unpacked(batch: pa.RecordBatch) -> np.ndarray:
    return np.frombuffer(b"".join(batch.column("codes").to_pylist()), np.uint8).reshape(-1, WIDTH)


def _packed(table: pa.Table) -> pa.Table:
    """One task's findings as a row, in the order of their codes."""
    table = table.sort_by([("codes", "ascending"), ("label", "ascending")])
    return pa.table({"part": table.column("part").slice(0, 1), "codes": pa.array([b"".join(table.column("codes").to_pylist())], pa.binary()),
                     "labels": pa.array([np.array(table.column("label").to_pylist(), np.uint8).tobytes()], pa.binary())})


def _trained(batches: Iterator[pa.RecordBatch], net: Network, state: list, step: int, share: float, seed: int,
             batch_size: int) -> Iterator[pa.RecordBatch]:
    """Parameters and Adam's means after one epoch over each part, as one array of doubles."""
    for batch in batches:
        for part, codes, labels in zip(*(batch.column(c).to_pylist() for c in ("part", "codes", "labels"))):
            own, held = copy.deepcopy((net, state))
            x = np.frombuffer(codes, np.uint8).reshape(-1, WIDTH).astype(np.int64)
            y = np.frombuffer(labels, np.uint8).astype(float)
            # Rare secrets come several times, each time with less weight, so that most steps see some.
            times = np.where(y == 1, min(32, max(1, int((1 - share) / share) // 8)), 1)
            order = np.random.default_rng((seed, part)).permutation(np.repeat(np.arange(len(x)), times))
            after = _epoch(own, held, step, x, y, _class_weights(y, share) / times, order, batch_size)
            flat = np.concatenate([a.ravel() for a in [*own.params(), *(a for pair in held for a in pair)]])
            yield pa.RecordBatch.from_pydict({"n": pa.array([len(x)], pa.int64()), "step": pa.array([after], pa.int64()),
                                              "flat": pa.array([flat.tobytes()], pa.binary())})


def _logits(batches: Iterator[pa.RecordBatch], net: Network) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield pa.RecordBatch.from_arrays([batch.column("label"), pa.array(
            np.floor(net.logits(_unpacked(batch)) * GRID).astype(np.int64), pa.int64())], ["label", "logit"])


def train_on(docs: DataFrame, recall: float = RECALL, seed: int = 5, epochs: int = EPOCHS, batch: int = 128,
             task_findings: int = TASK_FINDINGS) -> Network:
    """Train on three quarters of the findings of all documents; scaling and threshold from the last quarter.

    Every finding is trained on, up to ``epochs`` times and at least once.

    The driver gets the parameters of each task (35 KB), and counts of held-out logits.
    """
    net = Network.fresh(np.random.default_rng(seed))
    hashed = findings(docs).withColumn("hash", F.xxhash64("codes", "label"))
    found = stage(hashed.withColumn("held", F.pmod("hash", F.lit(4)) == 0), "secret-findings")
    counts = {r.label: r["count"] for r in found.where("not held").groupBy("label").count().collect()}
    used = sum(counts.values())
    if len(counts) < 2:  # nothing to learn from: no score reaches the threshold
        net.threshold = 1.1
        return net
    parts = 1 + used // task_findings
    dealt = found.where("not held").withColumn("part", F.pmod(F.shiftright("hash", 2), F.lit(parts)).cast("int"))
    packed = stage(dealt.groupBy("part").applyInArrow(_packed, "part int, codes binary, labels binary"), "secret-parts")
    packed = packed.repartition(parts, "part")
    state, step, share = net.fresh_state(), 0, counts[1] / used
    for epoch in range(max(1, min(epochs, TRAINED // used))):
        now = (net, state, step, share, seed + epoch, batch)
        rows = packed.mapInArrow(lambda b, now=now: _trained(b, *now), "n long, step long, flat binary").collect()
        flat = sum(np.frombuffer(r.flat) * (r.n / used) for r in sorted(rows, key=lambda r: r.flat))
        for a in [*net.params(), *(a for pair in state for a in pair)]:
            a[...], flat = flat[:a.size].reshape(a.shape), flat[a.size:]
        step = max(r.step for r in rows)
    held = found.where("held").select("codes", "label").mapInArrow(lambda b: _logits(b, net), "label int, logit long")
    rows = sorted(held.groupBy("label", "logit").count().collect())
    label, logit, times = np.array(rows, dtype=float).reshape(-1, 3).T
    _calibrate(net, logit / GRID, label, times, recall)
    return net


def _scan(batches: Iterator[pa.RecordBatch], net: Network) -> Iterator[pa.RecordBatch]:
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("stop", pa.int32())]))
    for batch in batches:
        texts = [t or "" for t in batch.column("text").to_pylist()]
        spans = [base_spans(t) for t in texts]
        asked, own, first, size = [], [], 0, 0
        for row, text in enumerate(texts):
            found = []
            for a, b in candidates(text, spans[row]):
                for p in ((a, b),) if b - a <= BODY else pieces(a, b):
                    asked.append((row, a, b))
                    found.append(p)
            own.append(found)
            size += len(found)
            if size >= AT_ONCE or row == len(texts) - 1:
                hits = net.scores(windows_of(texts[first:row + 1], own)) >= net.threshold
                for at, a, b in dict.fromkeys(asked[i] for i in np.flatnonzero(hits)):
                    spans[at].append((a, "network", b))
                asked, own, first, size = [], [], row + 1, 0
        order = [*KINDS, "network"].index
        spelled = [[{"kind": k, "start": a, "stop": b} for a, k, b in sorted(own, key=lambda s: (s[0], order(s[1]), s[2]))]
                   for own in spans]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(spelled, kind)], ["doc_id", "spans"])


def find_secrets(docs: DataFrame, net: Network | None = None) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id and spans, an array of (kind, start, stop) by start, then kind.

    Kinds: assign, access, hex, network. Positions are code points, stop
    exclusive. Null and empty texts have no spans; repeated rows get equal
    spans. Without any labelled secret the network adds nothing.
    """
    net = net or train_on(docs)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(lambda batches: _scan(batches, net),
                           "doc_id long, spans array<struct<kind:string,start:int,stop:int>>")
