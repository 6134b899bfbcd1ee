"""Personal data: fixed patterns, and bootstrapped contextual extraction on top.

All in DataFrame functions. Four kinds of identifiers have fixed patterns;
their matches are always spans. They are also the seeds of a bootstrap: the
words beside a seed make lexical patterns: the word before, the word after, the
two words before, and the words on both sides. A pattern counts if its words
stand beside known identifiers far more often than words at random places do;
its confidence is the known share of the identifier-like tokens it stands
beside. So a cue word may be common in prose too. Each round scores the
patterns, then every unknown identifier-like token by the patterns it occurs
with and the share of its own uses that is beside them; tokens of high score
become known and count for the next round. Occurrences of such tokens beside
high-confidence patterns are added as kind ``context``.

Positions of matches come from the lengths between them: the texts between the
matches of a pattern (``split``) and the matches (``regexp_extract_all``)
alternate, so a running sum of lengths gives every start, in code points.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakelayer.llm.common import stage

KINDS = ["email", "ip", "card", "phone"]
# The fixed patterns, with possessive repeats and, for email and ip, a start only where
# a run of its first characters starts or the last match ended. Both leave the matches as
# they are and keep the work linear on long runs.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# Cheap tests that every text with a match passes.
HINTS = {
    "email": lambda text: F.contains(text, F.lit("@")),
    "ip": lambda text: text.rlike(r"[0-9]\.[0-9]"),
    "card": lambda text: text.rlike(r"[0-9][\x20-]?[0-9]"),
    "phone": lambda text: F.contains(text, F.lit("+")),
}
BYTE_VALUE = r"0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
# An identifier-like token: no white space, with a digit.
TOKEN = r"(?<!\S)(?=[^\s0-9]*+[0-9])\S++"
NEAR = 48  # code points that mostly hold the neighbouring words; the whole text between matches is read if not

ROUNDS = 3
LEAST_SUPPORT = 3
LEAST_CONFIDENCE = 0.7
KNOWN_SCORE = 0.7
LEAST_LIFT = 5  # times the hits that chance would give, one more allowed for


def holds(kind: str, match: Column) -> Column:
    """Whether a match of ``kind`` meets the kind's further condition."""
    digits = F.regexp_replace(match, "[^0-9]", "")
    if kind == "ip":
        return match.rlike(rf"^{BYTE_VALUE}(?:\.{BYTE_VALUE}){{3}}$")
    if kind == "card":
        return F.length(digits).between(16, 19) & F.call_function("luhn_check", digits)
    if kind == "phone":
        return F.length(digits).between(8, 15)
    return F.lit(True)


def last_words(gap: Column) -> tuple[Column, Column]:
    """The last word of a text and the one before it; empty where there is none."""
    tail = F.right(gap, F.lit(NEAR))
    tail = F.when((F.length(gap) <= NEAR) | tail.rlike(r"\s\S++\s++\S++\s*+$"), tail).otherwise(gap)
    return F.regexp_extract(tail, r"(?<!\S)(\S++)\s*+$", 1), F.regexp_extract(tail, r"(?<!\S)(\S++)\s++\S++\s*+$", 1)


def first_word(gap: Column) -> Column:
    head = F.left(gap, F.lit(NEAR))
    head = F.when((F.length(gap) <= NEAR) | head.rlike(r"^\s*+\S++\s"), head).otherwise(gap)
    return F.regexp_extract(head, r"^\s*+(\S++)", 1)


def matches(text: Column, kind: str, pattern: str, hint: Column) -> Column:
    """Array of all matches: kind, nth, gap (length of the text since the match before), value, the words beside it."""
    def around(gap: Column) -> Column:
        last, before = last_words(gap)
        return F.struct(F.length(gap).alias("gap"), last.alias("last"), before.alias("before"), first_word(gap).alias("first"))

    gaps = F.transform(F.split(text, pattern, -1), around)
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    after = F.transform(F.slice(gaps, 2, F.size(found) + 1), lambda g: g["first"])
    zipped = F.arrays_zip(found.alias("value"), F.slice(gaps, 1, F.size(found)).alias("gap"), after.alias("right"))
    each = F.transform(zipped, lambda z, i: F.struct(
        F.lit(kind).alias("kind"), i.alias("nth"), z["gap"]["gap"].alias("gap"), z["value"].alias("value"),
        z["gap"]["before"].alias("before"), z["gap"]["last"].alias("left"), z["right"].alias("right")))
    empty = F.array().cast(
        "array<struct<kind:string,nth:int,gap:int,value:string,before:string,left:string,right:string>>")
    return F.when(hint, each).otherwise(empty)


def all_matches(docs: DataFrame) -> DataFrame:
    """Matches of the four kinds and identifier-like tokens, with start and stop: one row each.

    Rows with equal key (equal doc_id and text) have equal matches, kept once.
    """
    text = F.col("text")
    kinds = [matches(text, k, PATTERNS[k], HINTS[k](text)) for k in KINDS]
    tokens = matches(text, "token", TOKEN, text.rlike("[0-9]"))
    each = docs.where(text.rlike("[0-9@]")).select("key", F.explode(F.concat(*kinds, tokens)).alias("m")).select("key", "m.*")
    each = each.dropDuplicates(["key", "kind", "nth"])
    own = Window.partitionBy("key", "kind").orderBy("nth")
    stop = F.sum(F.col("gap") + F.length("value")).over(own)
    good = F.lit(False)
    for kind in KINDS:
        good = good | ((F.col("kind") == kind) & holds(kind, F.col("value")))
    return (
        each.withColumn("stop", stop.cast("int"))
        .withColumn("start", F.col("stop") - F.length("value"))
        .withColumn("base", good)
        .where("base or kind = 'token'")
        .select("key", "kind", "start", "stop", "value", "before", "left", "right", "base")
    )


def instance(value: Column) -> Column:
    """A token as the graph knows it: lower case, without punctuation at its ends."""
    return F.regexp_replace(F.lower(value), r"^[^\p{L}0-9+]+|[^\p{L}0-9]+$", "")


def with_patterns(found: DataFrame) -> DataFrame:
    """One row per match and pattern: the columns of ``found``, instance, side, cue (a word or two), pattern."""
    before, left, right = (F.lower(c) for c in ("before", "left", "right"))
    none = F.lit("")

    def side(name: str, cue: Column) -> Column:
        return F.struct(F.lit(name).alias("side"), cue.alias("cue"))

    sides = F.array(
        side("left", left), side("right", right),
        side("two", F.when((before != "") & (left != ""), F.concat_ws(" ", before, left)).otherwise(none)),
        side("around", F.when((left != "") & (right != ""), F.concat_ws(" ", left, right)).otherwise(none)))
    each = found.withColumn("instance", instance(F.col("value"))).withColumn("s", F.explode(sides))
    # Marks between words, as of table cells, are no words: every word of a cue holds a letter.
    worded = F.col("cue").rlike(r"^\S*\p{L}\S*(?: \S*\p{L}\S*)?$") & (F.col("instance") != "")
    each = each.select("*", "s.side", "s.cue").drop("s").where(worded)
    return each.withColumn("pattern", F.concat_ws(" ", "side", "cue"))


def cue_uses(docs: DataFrame, cues: DataFrame) -> DataFrame:
    """(cue, uses): how often each cue, a word or two neighbouring words, stands in all texts."""
    words = docs.select(F.split(F.lower("text"), r"\s+").alias("words"))
    count = F.size("words") - 1
    pairs = F.zip_with(F.slice("words", 1, count), F.slice("words", 2, count), lambda a, b: F.concat_ws(" ", a, b))
    each = words.select(F.explode(F.concat("words", pairs)).alias("cue"))
    return each.join(cues, "cue", "left_semi").groupBy("cue").agg(F.count(F.lit(1)).alias("uses"))


def discover(found: DataFrame, docs: DataFrame, rounds: int = ROUNDS, support: int = LEAST_SUPPORT,
             confidence: float = LEAST_CONFIDENCE, known: float = KNOWN_SCORE, lift: float = LEAST_LIFT) -> DataFrame:
    """Spans (key, start, stop) of unseen identifiers beside high-confidence patterns.

    A pattern needs ``support`` different known instances, ``confidence`` (the
    known share of the identifier-like tokens beside it), and hits that are no
    chance: at least ``lift`` times one more than its cue's uses in the corpus
    would have at the corpus's rate of identifiers a word, or half of the uses.
    An unknown token's score is 1 - product of (1 - confidence) over such
    patterns, times the share of its uses beside them; at ``known`` it becomes
    known. Counts are over all documents.
    """
    seeds = found.where("base")
    # A token that shares characters with a seed is not unseen.
    tokens = found.where(F.col("kind") == "token")
    inside = seeds.select("key", F.col("start").alias("a"), F.col("stop").alias("b"))
    tokens = tokens.join(inside, (tokens["key"] == inside["key"]) & (tokens["start"] < inside["b"])
                         & (tokens["stop"] > inside["a"]), "left_anti")
    seen = stage(with_patterns(seeds.union(tokens)), "pii-contexts")
    words = docs.agg(F.sum(F.size(F.split("text", r"\s+")).cast("long"))).first()[0] or 1
    rate = seeds.count() / words

    edges = seen.groupBy("pattern", "side", "cue", "instance").agg(F.max("base").alias("seed"), F.count(F.lit(1)).alias("n"))
    # Only a pattern beside enough different tokens can ever matter.
    enough = edges.groupBy("pattern", "cue").agg(F.countDistinct("instance").alias("k")).where(F.col("k") >= support)
    enough = stage(enough.select("pattern", "cue"), "pii-cues")
    uses = stage(cue_uses(docs, enough.select("cue").distinct()), "pii-uses")
    graph = stage(edges.join(enough.select("pattern"), "pattern", "left_semi").join(uses, "cue", "left"), "pii-graph")
    # A token's own uses: one side names each of them, unless it has no word there.
    own = stage(edges.groupBy("instance").agg(
        F.max(F.col("seed").cast("int")).cast("double").alias("seed"),
        F.greatest(*(F.sum(F.when(F.col("side") == s, F.col("n")).otherwise(0)) for s in ("left", "right"))).alias("own")),
        "pii-instances")

    scores, strong = own.select("instance", F.col("seed").alias("score")), None
    for _ in range(rounds):
        hit = F.col("score") >= known
        strong = graph.join(scores, "instance").groupBy("pattern").agg(
            F.sum(F.when(hit, F.col("n")).otherwise(0)).alias("hits"), F.sum("n").alias("met"),
            F.countDistinct(F.when(hit, F.col("instance"))).alias("support"),
            # A pattern on both sides is a pair of neighbours with a token between: not in ``uses``.
            (F.coalesce(F.max("uses"), F.lit(0)) + F.sum(F.when(F.col("side") == "around", F.col("n")).otherwise(0))).alias("uses"))
        strong = strong.withColumn("uses", F.greatest("uses", "met")).withColumn("confidence", F.col("hits") / F.col("met"))
        by_chance = F.col("uses") * F.lit(rate) + 1
        strong = strong.where((F.col("support") >= support) & (F.col("confidence") >= confidence)
                              & ((F.col("hits") >= lift * by_chance) | (2 * F.col("hits") >= F.col("uses"))))
        by_pattern = graph.join(strong.select("pattern", "confidence"), "pattern").groupBy("instance").agg(
            F.sum("n").alias("beside"),
            (1 - F.exp(F.sum(F.log(F.greatest(F.lit(1e-9), 1 - F.col("confidence")))))).alias("found"))
        share = F.least(F.lit(1.0), F.col("beside") / F.greatest("own", F.lit(1)))
        scores = stage(own.join(by_pattern, "instance", "left").select(
            "instance", F.greatest("seed", F.coalesce(F.col("found") * share, F.lit(0.0))).alias("score")), "pii-scores")
    unseen = seen.where("not base").join(strong.select("pattern"), "pattern", "left_semi")
    return unseen.join(scores.where(F.col("score") >= known), "instance", "left_semi").select(
        "key", "start", "stop").distinct()


def find_personal_data(docs: DataFrame) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id and spans, an array of (kind, start, stop), base kinds first.

    Sorted by kind as listed, ``context`` last, then start. Null and empty
    texts have no spans. Repeated rows get equal results. The document's text
    is not shuffled: matches alone are.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumn("key", F.xxhash64("doc_id", "text"))
    found = stage(all_matches(rows), "pii-matches")
    more = discover(found, rows).withColumn("kind", F.lit("context"))
    spans = found.where("base").select("key", "kind", "start", "stop").union(more.select("key", "kind", "start", "stop"))
    order = F.array_position(F.array(*map(F.lit, [*KINDS, "context"])), F.col("kind")).cast("int")
    own = spans.groupBy("key").agg(F.sort_array(F.collect_list(
        F.struct(order.alias("rank"), "start", "stop", "kind"))).alias("spans"))
    found = rows.select("doc_id", "key").join(own, "key", "left")
    kept = F.transform("spans", lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["stop"].alias("stop")))
    empty = F.array().cast("array<struct<kind:string,start:int,stop:int>>")
    return found.select("doc_id", "key", F.coalesce(kept, empty).alias("spans"))


def masked(docs: DataFrame) -> DataFrame:
    """``docs`` with every span in text replaced by its kind in brackets; other columns unchanged.

    Overlapping spans are replaced as one, named by the first. Null text stays null.
    """
    from lakelayer.llm.common import spare_name

    key, own = spare_name(docs, "key"), spare_name(docs, "spans")
    found = find_personal_data(docs.select("doc_id", "text")).where(F.size("spans") > 0)
    found = found.groupBy("key").agg(F.first("spans").alias(own)).withColumnRenamed("key", key)
    rows = docs.withColumn(key, F.xxhash64(F.col("doc_id").cast("long"), F.coalesce("text", F.lit(""))))
    ordered = F.array_sort(F.transform(own, lambda s: F.struct(s["start"].alias("start"), s["stop"].alias("stop"), s["kind"].alias("kind"))))
    start = F.struct(F.lit("").alias("done"), F.lit(0).alias("at"))

    def add(state: Column, s: Column) -> Column:
        fresh = s["start"] >= state["at"]
        gap = F.substring("text", state["at"] + 1, F.greatest(s["start"] - state["at"], F.lit(0)))
        done = F.when(fresh, F.concat(state["done"], gap, F.lit("["), s["kind"], F.lit("]"))).otherwise(state["done"])
        return F.struct(done.alias("done"), F.greatest(state["at"], s["stop"]).alias("at"))

    state = F.aggregate(ordered, start, add, lambda s: F.concat(s["done"], F.substring(
        "text", s["at"] + 1, F.greatest(F.length("text") - s["at"], F.lit(0)))))
    clean = rows.join(found, key, "left").withColumn("text", F.when(F.col(own).isNull(), F.col("text")).otherwise(state))
    return clean.select(*docs.columns)
