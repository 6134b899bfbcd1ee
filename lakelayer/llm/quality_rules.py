"""Quality rules as a short-circuit cascade.

Every rule is a test of one document. What a rule costs and how many documents
it rejects is measured on a bounded sample; rules then run in order of
rejections per second, each on the documents that all earlier ones let pass.
The order changes the cost, never the verdict: a document is kept if no rule
rejects it.
"""

from __future__ import annotations

import re
import time
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StructType

from lakelayer.llm.common import handed_back, spare_name

SAMPLE_ROWS = 2_000
SYMBOLS = re.compile(r"[#*$%&|<>]")
PIECES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


class Document:
    """One text with its measures, each computed once, when first asked for."""

    def __init__(self, text: str | None):
        self.text = text or ""
        self.held: dict = {}

    def measure(self, name: str):
        if name not in self.held:
            self.held[name] = MEASURES[name](self)
        return self.held[name]

    @property
    def words(self) -> list[bytes]:
        # bytes.split parts at exactly the six ASCII white-space characters.
        return self.measure("words")


def _repeat_words(doc: Document) -> int:
    """Words inside 3-word windows that occur at least twice in the text."""
    words = doc.words
    windows = Counter(zip(words, words[1:], words[2:]))
    if len(windows) == max(0, len(words) - 2):
        return 0
    count = covered = 0
    for i, window in enumerate(zip(words, words[1:], words[2:])):
        if windows[window] > 1:
            count += i + 3 - max(covered, i)
            covered = i + 3
    return count


def _dup_lines(doc: Document) -> int:
    lines = [line for line in doc.measure("bytes").split(b"\n") if line.split()]
    return len(lines) - len(set(lines))


def _word_chars(doc: Document) -> int:
    spaces = sum(map(doc.text.count, " \t\n\r\x0b\x0c"))
    return len(doc.text) - spaces


MEASURES: dict[str, Callable[[Document], object]] = {
    "bytes": lambda doc: doc.text.encode(),
    "words": lambda doc: doc.measure("bytes").split(),
    "n_words": lambda doc: len(doc.words),
    "word_chars": _word_chars,
    "n_symbols": lambda doc: len(SYMBOLS.findall(doc.text)),
    "n_dup_lines": _dup_lines,
    "n_lines": lambda doc: sum(1 for line in doc.measure("bytes").split(b"\n") if line.split()),
    "n_repeat_words": _repeat_words,
}


@dataclass(frozen=True)
class Rule:
    name: str
    rejects: Callable[[Document], bool]
    base: bool = False


# The base rules are given; the others reject only what no prose in four languages comes near.
RULES = [
    Rule("few_words", lambda d: d.measure("n_words") < 50, base=True),
    Rule("repeated_words", lambda d: 100 * d.measure("n_repeat_words") > 50 * d.measure("n_words"), base=True),
    Rule("symbols", lambda d: 100 * d.measure("n_symbols") > 35 * d.measure("n_words")),
    Rule("repeated_lines", lambda d: 100 * d.measure("n_dup_lines") > 60 * d.measure("n_lines")),
    Rule("long_words", lambda d: d.measure("word_chars") > 20 * d.measure("n_words")),
    Rule("short_words", lambda d: d.measure("word_chars") < 2 * d.measure("n_words")),
]


def cascade(rules: list[Rule], doc: Document) -> str | None:
    """Name of the first rule that rejects, or None; later rules are not run."""
    return next((rule.name for rule in rules if rule.rejects(doc)), None)


def _trial(batches: Iterator[pa.RecordBatch], rules: list[Rule]) -> Iterator[pa.RecordBatch]:
    """Seconds and rejections of every rule on its own, over the rows of a task."""
    for batch in batches:
        texts = batch.column("text").to_pylist()
        seconds, rejected = [], []
        for rule in rules:
            began = time.perf_counter()
            rejected.append(sum(rule.rejects(Document(text)) for text in texts))
            seconds.append(time.perf_counter() - began)
        yield pa.RecordBatch.from_pydict({
            "rule": [rule.name for rule in rules], "n": [len(texts)] * len(rules),
            "rejected": rejected, "seconds": seconds})


def order_rules(docs: DataFrame, rules: list[Rule] = RULES, sample_rows: int = SAMPLE_ROWS) -> list[Rule]:
    """``rules`` by rejections per second of cost, measured on about ``sample_rows`` documents.

    The sample is the documents with the lowest hashes, so its size is bounded
    at any input size. Rules that reject nothing come last, cheapest first.
    """
    total = docs.count()
    if not total:
        return list(rules)
    # The highest hash of the sample: a share of all 2**64 hashes.
    limit = min(2**63 - 1, (2**64 * sample_rows) // total - 2**63)
    sample = docs.select("text").where(F.xxhash64("text") <= F.lit(limit))
    schema = "rule string, n long, rejected long, seconds double"
    tried = sample.mapInArrow(lambda batches: _trial(batches, rules), schema)
    found = {r["rule"]: (r["rejected"], r["seconds"]) for r in tried.groupBy("rule").agg(
        F.sum("rejected").alias("rejected"), F.sum("seconds").alias("seconds")).collect()}

    def worth(rule: Rule) -> tuple[float, float]:
        rejected, seconds = found.get(rule.name, (0, 0.0))
        return (-rejected / max(seconds, 1e-9), seconds)

    return sorted(rules, key=worth)


def _judge(batches: Iterator[pa.RecordBatch], rules: list[Rule]) -> Iterator[pa.RecordBatch]:
    base = [rule for rule in rules if rule.base]
    for batch in batches:
        rows = []
        for text in batch.column("text").to_pylist():
            doc = Document(text)
            kept = cascade(rules, doc) is None
            rows.append((*map(doc.measure, PIECES), any(rule.rejects(doc) for rule in base), kept))
        found = list(zip(*rows)) or [()] * (len(PIECES) + 2)
        kinds = [pa.int64()] * len(PIECES) + [pa.bool_()] * 2
        arrays = [pa.array(values, kind) for values, kind in zip(found, kinds)]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *arrays], ["doc_id", *PIECES, "base_failed", "kept"])


def _flag(batches: Iterator[pa.RecordBatch], rules: list[Rule], flag: str) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        kept = pa.array([cascade(rules, Document(text)) is None for text in batch.column("text").to_pylist()])
        yield pa.RecordBatch.from_arrays([*batch.columns, kept], names=[*batch.schema.names, flag])


def judge(docs: DataFrame, rules: list[Rule] = RULES, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """Per document: doc_id, the measures, base_failed and kept (no rule rejects it).

    Null and empty texts have no words and fail the first base rule. Repeated
    rows are judged alike; an empty table gives an empty result.
    """
    rules = order_rules(docs, rules, sample_rows)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    longs = ", ".join(f"{name} long" for name in PIECES)
    return rows.mapInArrow(lambda batches: _judge(batches, rules),
                           f"doc_id long, {longs}, base_failed boolean, kept boolean")


def kept_documents(docs: DataFrame, rules: list[Rule] = RULES, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """The rows of ``docs`` that pass the cascade, all columns unchanged; no measure is run beyond the first rejection."""
    rules = order_rules(docs, rules, sample_rows)
    flag = spare_name(docs, "kept")
    schema = StructType([*docs.schema.fields]).add(flag, BooleanType())
    return docs.mapInArrow(lambda batches: handed_back(_flag(batches, rules, flag)), schema).where(F.col(flag)).drop(flag)
