"""Secret scan over a trigram inverted index, with DataFrame functions only.

Every rule's regular expression gives a Boolean trigram query: an OR over its ways to match, each an AND of
the trigrams that way must contain. The index holds the postings of all trigrams that some rule asks for;
postings are intersected per document, and only candidates meet the regular expression. A rule with a way
to match that has no trigram (such as a run of hexadecimal digits) scans every text.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce
from operator import and_
from re import _constants as C
from re import _parser

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorloom.llm.common import shielded


@dataclass(frozen=True)
class Rule:
    """``group``'s match must have ``least`` characters; a shorter match is dropped."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0
    base: bool = False


#: The base kinds in their listed order, then kinds the method adds.
RULES = (
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
         2, 8, True),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 16, True),
    Rule("hex", r"[0-9a-f]{32,}", 0, 32, True),  # a shorter run holds no longer one
    Rule("private_key", r"-----BEGIN (?:[A-Z]+ )?PRIVATE KEY-----"),
    Rule("hosted_git", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("chat_token", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("web_token", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]+"),
)
_WAYS = 256  # a pattern with more ways to match than this scans fully


def _ways(parsed) -> list[list[str]]:
    """Ways to match, each a list of literal runs; "\\0" stands for anything else."""
    ways = [""]
    for op, arg in parsed:
        if op is C.LITERAL:
            tails = [chr(arg)]
        elif op is C.SUBPATTERN:
            tails = _ways(arg[-1])
        elif op is C.BRANCH:
            tails = [t for branch in arg[1] for t in _ways(branch)]
        elif op is C.IN and all(k is C.LITERAL for k, _ in arg) and len(arg) <= 8:
            tails = [chr(v) for _, v in arg]
        elif op in (C.MAX_REPEAT, C.MIN_REPEAT):
            low, high, inner = arg
            once = _ways(inner)
            if (low, high) == (0, 1):
                tails = ["", *once]
            else:
                tails = ["\0"] if low == 0 else [t + "\0" + t for t in once] if low > 1 else [t + "\0" for t in once]
        else:
            tails = ["\0"]
        ways = list(dict.fromkeys(w + t for w in ways for t in tails))
        if len(ways) > _WAYS:
            return ["\0"]
    return ways


def trigram_query(pattern: str) -> list[frozenset[str]] | None:
    """OR of ANDs of lower-case trigrams that every match contains; None where a match may have none."""
    query = set()
    for way in _ways(_parser.parse(pattern)):
        runs = [run.lower() for run in way.split("\0")]
        needed = frozenset(run[i:i + 3] for run in runs for i in range(len(run) - 2))
        if not needed:
            return None
        query.add(needed)
    # A way that asks for more than another one adds nothing to the OR.
    return sorted((q for q in query if not any(other < q for other in query)), key=sorted)


CHUNK = 512  # spans that one fold goes over; folds copy what they gather


def _with(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is worked out once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _chunks(items: Column) -> Column:
    """An array cut into arrays of :data:`CHUNK` elements."""
    return _with(items, lambda a: F.transform(
        F.sequence(F.lit(0), F.floor((F.size(a) - 1) / CHUNK).cast("int")), lambda c: F.slice(a, c * CHUNK + 1, F.lit(CHUNK))))


def _before(totals: Column, add: Callable[[Column, Column], Column]) -> Column:
    """Per element what ``add`` makes of 0 and all elements before it."""
    return F.aggregate(totals, F.array(F.lit(0)), lambda acc, x: F.concat(acc, F.array(add(F.element_at(acc, -1), x))))


def _key() -> Column:
    # Equal keys of different rows only make one more text a candidate.
    return F.xxhash64("doc_id", "text")


def postings(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The inverted index of all trigrams that the rules ask for: ``trigram, doc`` (a hash of the row)."""
    wanted = sorted({t for rule in rules for way in trigram_query(rule.pattern) or () for t in way})
    asked = F.array(*[F.lit(t) for t in wanted])
    # The lowered text is an element, so it is made once per text and not once per trigram.
    held = _with(F.lower("text"), lambda low: F.filter(asked, lambda t: F.contains(low, t)))
    return docs.select(_key().alias("doc"), F.explode(held).alias("trigram"))


def candidates(index: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Documents whose postings meet some rule's query: ``doc, rules`` (positions in ``rules``)."""
    queries = {i: q for i, rule in enumerate(rules) if (q := trigram_query(rule.pattern)) is not None}
    trigrams = sorted({t for q in queries.values() for way in q for t in way})
    words = range(max(1, -(-len(trigrams) // 63)))  # as many masks of 63 trigrams as the rules need
    place = {t: divmod(i, 63) for i, t in enumerate(trigrams)}
    number = F.create_map(*[x for i, t in enumerate(trigrams) for x in (F.lit(t), F.lit(i))])
    bit = F.element_at(number, F.col("trigram"))
    masks = [F.bit_or(F.when((bit >= 63 * k) & (bit < 63 * (k + 1)), F.expr(f"shiftleft(1L, n - {63 * k})"))
                      .otherwise(F.lit(0).cast("bigint"))).alias(f"mask{k}") for k in words]
    met = index.withColumn("n", bit).groupBy("doc").agg(*masks)

    def way(trigrams: frozenset[str]) -> Column:
        need = [0 for _ in words]
        for t in trigrams:
            need[place[t][0]] |= 1 << place[t][1]
        return reduce(and_, [F.col(f"mask{k}").bitwiseAND(F.lit(n).cast("bigint")) == n for k, n in enumerate(need)])

    hits = F.array(*[F.when(F.exists(F.array(*[way(w) for w in q]), lambda x: x), F.lit(i))
                     for i, q in queries.items()])
    return met.select("doc", F.array_compact(hits).alias("rules")).where(F.size("rules") > 0)


def _spans(rule: Rule, position: int) -> Column:
    """Spans of one rule: ``start, position, end, kind`` in code points, end exclusive, leftmost first."""
    pattern = F.lit(rule.pattern)
    found = F.regexp_extract_all("text", pattern, F.lit(0))
    held = F.regexp_extract_all("text", pattern, F.lit(rule.group)) if rule.group else found
    parts = F.arrays_zip(F.slice(F.split("text", rule.pattern, -1), F.lit(1), F.size(found)).alias("gap"),
                         found.alias("hit"), held.alias("held"))
    span = "struct<start:int,position:int,end:int,kind:string>"
    # Lengths alone go through the folds; a chunk starts where the lengths before it end.
    sizes = F.transform(parts, lambda x: F.struct(F.length(x["gap"]).alias("gap"), F.length(x["hit"]).alias("hit"),
                                                  F.length(x["held"]).alias("held")))

    def step(acc: Column, x: Column) -> Column:
        start = acc["at"] + x["gap"]
        end = start + x["hit"]
        one = F.struct(start.alias("start"), F.lit(position).alias("position"), end.alias("end"),
                       F.lit(rule.kind).alias("kind"))
        return F.struct(end.alias("at"), F.when(x["held"] >= rule.least, F.concat(acc["out"], F.array(one)))
                        .otherwise(acc["out"]).alias("out"))

    def spans(chunk: Column, at: Column) -> Column:
        zero = F.struct(at.alias("at"), F.array().cast(f"array<{span}>").alias("out"))
        return F.aggregate(chunk, zero, step, lambda acc: acc["out"])

    def all_spans(chunks: Column) -> Column:
        totals = F.transform(chunks, lambda c: F.aggregate(c, F.lit(0), lambda n, x: n + x["gap"] + x["hit"]))
        return F.flatten(F.zip_with(chunks, F.slice(_before(totals, lambda a, b: a + b), F.lit(1), F.size(chunks)), spans))

    return F.when(F.size(found) > 0, _with(_chunks(sizes), all_spans)).otherwise(F.array().cast(f"array<{span}>"))


def find_spans(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """All columns of ``docs`` and ``spans``: an array of ``start, position, end, kind`` by start, then kind.

    A NULL or empty text has no span; NULL and repeated doc_ids are rows of their own; a column named
    ``spans`` is replaced; an empty table gives an empty one. Texts are searched whole, however long and however many
    hits they have: hits are gone through in chunks, so the time grows with the text and its hits.
    """
    docs = docs.drop("spans").withColumn("_doc", _key())
    found = candidates(postings(docs, rules), rules).select(F.col("doc").alias("_doc"), F.col("rules").alias("_rules"))
    none = F.array().cast("array<struct<start:int,position:int,end:int,kind:string>>")
    each = []
    for i, rule in enumerate(rules):
        full = trigram_query(rule.pattern) is None
        asked = F.col("text").rlike(rule.pattern) if full else F.array_contains("_rules", F.lit(i))
        each.append(F.when(asked, _spans(rule, i)).otherwise(none))
    # The candidates fit a hash table per partition, so the texts need no sort.
    return (docs.join(found.hint("shuffle_hash"), "_doc", "left")
            .withColumn("spans", F.array_sort(F.concat(*each))).drop("_doc", "_rules"))


def report(spans: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Per document the counts of the base kinds, a digest of the base spans and all spans as text."""
    base = [i for i, rule in enumerate(rules) if rule.base]

    def joined(column: Column) -> Column:
        return F.concat_ws(",", F.transform(column, lambda s: F.concat_ws(
            ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint")

    of_base = F.filter("spans", lambda s: s["position"].isin(base))
    return spans.select("doc_id", *[count(rules[i].kind).alias(f"n_{rules[i].kind}") for i in base],
                        F.sha2(joined(of_base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))


def redact(docs: DataFrame, rules: tuple[Rule, ...] = RULES, mark: str = "[SECRET]") -> DataFrame:
    """The documents with every span replaced by ``mark``; overlapping spans become one mark."""
    return shielded(docs, ("spans", "_doc", "_rules"), lambda docs: _redacted(docs, rules, mark))


def _redacted(docs: DataFrame, rules: tuple[Rule, ...], mark: str) -> DataFrame:
    def step(acc: Column, s: Column) -> Column:
        """Pieces ``from, to`` of the text between marks; a span that starts inside an earlier one adds none."""
        inside = s["start"] < acc["at"]
        piece = F.struct(acc["at"].alias("from"), s["start"].alias("to"))
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"),
                        F.when(inside, acc["out"]).otherwise(F.concat(acc["out"], F.array(piece))).alias("out"))

    def pieces(chunk: Column, at: Column) -> Column:
        zero = F.struct(at.alias("at"), F.array().cast("array<struct<from:int,to:int>>").alias("out"))
        return F.aggregate(chunk, zero, step, lambda acc: acc["out"])

    def marked(chunk: Column) -> Column:
        """The text from a chunk's first piece to its last, cut out once, its pieces joined by the mark."""
        first, last = F.get(chunk, F.lit(0)), F.element_at(chunk, -1)
        part = F.col("text").substr(first["from"] + 1, last["to"] - first["from"])
        return _with(part, lambda t: F.array_join(F.transform(
            chunk, lambda p: F.substring(t, p["from"] - first["from"] + 1, p["to"] - p["from"])), mark))

    def clean(chunks: Column) -> Column:
        ends = F.transform(chunks, lambda c: F.array_max(F.transform(c, lambda s: s["end"])))
        ats = F.slice(_before(ends, F.greatest), F.lit(1), F.size(chunks))
        kept = F.filter(F.zip_with(chunks, ats, pieces), lambda c: F.size(c) > 0)
        tail = F.expr("substring(text, array_max(transform(spans, s -> s.end)) + 1)")
        return F.concat(F.array_join(F.transform(kept, marked), mark), F.lit(mark), tail)

    clean = _with(_chunks(F.col("spans")), clean)
    return (find_spans(docs, rules).withColumn("text", F.when(F.size("spans") > 0, clean).otherwise(F.col("text")))
            .select(*docs.columns))
