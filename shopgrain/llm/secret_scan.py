"""Secret scans over a trigram inverted index, by DataFrame functions only.

From each rule's regular expression a Boolean query over trigrams is derived: what any match must
contain. The index lists, for each trigram that some query asks for, the texts that hold it in
either case; texts go by their SHA-256, so copies are one text. Postings are intersected by
grouping them per text and asking the queries. Rules without a mandatory trigram scan every text
with a short test of their own and enter the index under their name. Only candidates are verified
with the rules themselves. Where a bounded run of matches needs positions, they are the running sum
of the lengths of matches and of what lies between, so they count code points.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import reduce
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopgrain.llm.frames import bind, fresh
from shopgrain.session import materialise

MAX_STRINGS = 64


@dataclass(frozen=True)
class Rule:
    """Matches of `regex` whose `group` has `least` characters. `test`: any text with such a match
    matches it; rules without mandatory trigrams scan with it."""

    kind: str
    regex: str
    least: int = 1
    group: int = 0
    test: str | None = None


# The base rules.
BASE = (
    Rule("assign", "((?i:password|passwd|secret|token|api_?key))[\"']?\\x20*[:=]\\x20*[\"']?"
         "([A-Za-z0-9+/_.=-]+)", 8, 2),
    Rule("access", "AKIA[A-Z0-9]+", 16),
    Rule("hex", "[0-9a-f]+", 32, 0, "[0-9a-f]{32}"),
)
# Public forms of further secrets.
MORE = (
    Rule("github", "gh[pousr]_[A-Za-z0-9]{36,255}"),
    Rule("google", "AIza[A-Za-z0-9_-]{35}"),
    Rule("pem", "-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----"),
)
RULES = BASE + MORE

# A query is a set of alternatives, each a set of trigrams that must all occur; None asks nothing.
Query = frozenset[frozenset[str]] | None


def trigram_query(regex: str) -> Query:
    """What trigrams, in lower case, any match of the expression holds."""
    parser = re._parser  # the standard library's own reading of regular expressions

    def both(a: Query, b: Query) -> Query:
        if a is None or b is None:
            return b if a is None else a
        return frozenset(x | y for x, y in product(a, b))

    def ask(strings: set[str]) -> Query:
        if any(len(s) < 3 for s in strings):
            return None
        return frozenset(frozenset(s[i:i + 3] for i in range(len(s) - 2)) for s in strings)

    def read(items) -> tuple[set[str] | None, Query]:
        """The strings of the sequence if they are few, and else the query of what was met."""
        strings, found, exact = {""}, None, True
        for op, value in items:
            more, asked = one(str(op), value)
            if more is not None and len(strings) * len(more) <= MAX_STRINGS:
                strings = {a + b for a, b in product(strings, more)}
                continue
            found, exact = both(both(found, ask(strings)), asked or (more and ask(more))), False
            strings = {""}
        return (strings, None) if exact else (None, both(found, ask(strings)))

    def one(op: str, value) -> tuple[set[str] | None, Query]:
        if op == "LITERAL":
            return {chr(value).lower()}, None
        if op == "AT":
            return {""}, None
        if op == "SUBPATTERN":
            return read(value[-1])
        if op == "BRANCH":
            parts = [read(x) for x in value[1]]
            if all(s is not None for s, _ in parts):
                return set().union(*(s for s, _ in parts)), None
            asked = [q if s is None else ask(s) for s, q in parts]
            return None, None if None in asked else frozenset().union(*asked)
        if op == "IN":
            chars: set[str] = set()
            for kind, x in value:
                if str(kind) == "LITERAL":
                    chars.add(chr(x).lower())
                elif str(kind) == "RANGE" and x[1] - x[0] < 8:
                    chars |= {chr(c).lower() for c in range(x[0], x[1] + 1)}
                else:
                    return None, None
            return chars, None
        if op in ("MAX_REPEAT", "MIN_REPEAT"):
            least, most, inner = value
            strings, asked = read(inner)
            if strings is not None and (least, most) == (0, 1):
                return strings | {""}, None
            if strings is not None and least == most <= 3:
                return {"".join(x) for x in product(strings, repeat=least)}, None
            return None, (asked or (strings and ask(strings))) if least else None
        return None, None

    strings, found = read(parser.parse(regex))
    return ask(strings) if strings is not None else found


def build_index(texts: DataFrame, text: Column, rules: tuple[Rule, ...]) -> DataFrame:
    """gram, text_key: the postings of all trigrams the rules ask for, and of rules without any."""
    queries = {r: trigram_query(r.regex) for r in rules}
    grams = sorted(set().union(*(g for q in queries.values() if q for g in q)))
    scans = [F.when(text.rlike(r.test or r.regex), F.lit(f"rule:{r.kind}"))
             for r, q in queries.items() if q is None]
    found = texts.where(text.isNotNull()).select(
        F.sha2(text, 256).alias("text_key"), F.array_compact(F.array(*scans)).alias("scans"),
        bind(F.lower(text), lambda lower: F.filter(
            F.array(*map(F.lit, grams)), lambda g: F.contains(lower, g))).alias("held"))
    return found.select("text_key", F.explode(F.concat("held", "scans")).alias("gram"))


def candidates(index: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """text_key, kinds: the texts that satisfy a rule's query, and those rules."""
    def asked(rule: Rule) -> Column:
        query = trigram_query(rule.regex)
        if query is None:
            return F.array_contains("grams", f"rule:{rule.kind}")
        return reduce(Column.__or__, [
            reduce(Column.__and__, [F.array_contains("grams", g) for g in sorted(all_of)])
            for all_of in sorted(query, key=sorted)])

    kinds = F.array_compact(F.array(*[F.when(asked(r), F.lit(r.kind)) for r in rules]))
    return index.groupBy("text_key").agg(F.collect_set("gram").alias("grams")).select(
        "text_key", kinds.alias("kinds")).where(F.size("kinds") > 0)


def spans_of(text: Column, rule: Rule, order: int) -> Column:
    """All spans of a rule in a text, by start: leftmost, non-overlapping matches."""
    regex = F.lit(rule.regex)
    between, whole = F.split(text, rule.regex, -1), F.regexp_extract_all(text, regex, F.lit(0))
    part = F.regexp_extract_all(text, regex, F.lit(rule.group))
    empty = F.lit(None).cast("array<struct<start:bigint,ord:int,kind:string,end:bigint>>")
    start = F.struct(F.lit(0).cast("bigint").alias("at"),
                     F.coalesce(empty, F.array()).cast(
                         "array<struct<start:bigint,ord:int,kind:string,end:bigint>>").alias("found"))

    def step(held: Column, x: Column) -> Column:
        begin = held["at"] + F.char_length(x["between"])
        end = begin + F.char_length(F.coalesce(x["whole"], F.lit("")))
        span = F.struct(begin.alias("start"), F.lit(order).alias("ord"),
                        F.lit(rule.kind).alias("kind"), end.alias("end"))
        good = F.char_length(F.coalesce(x["part"], F.lit(""))) >= rule.least
        return F.struct(end.alias("at"), F.when(
            good, F.concat(held["found"], F.array(span))).otherwise(held["found"]).alias("found"))

    zipped = F.arrays_zip(between.alias("between"), whole.alias("whole"), part.alias("part"))
    return F.aggregate(zipped, start, step, lambda held: held["found"])


def find_secrets(
    docs: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES,
) -> DataFrame:
    """docs with secret_spans, an array of (start, ord, kind, end) by start and then by rule.

    Positions are code points, `end` exclusive. NULL and empty texts have no spans. Repeated rows
    keep their number, and each gets the spans of its text; a column named secret_spans
    is replaced. Texts meet their spans again by hash; a hot text is one key on
    the small side, and the other side is split by AQE.
    """
    docs = docs.drop("secret_spans")
    index = materialise(build_index(docs.select(text), F.col(text), rules), "trigrams")
    found = candidates(index, rules)
    texts = docs.select(F.col(text).alias("body"), F.sha2(text, 256).alias("text_key"))
    spans = F.flatten(F.array(*[
        F.when(F.array_contains("kinds", r.kind), spans_of(F.col("body"), r, i)).otherwise(
            F.expr("CAST(array() AS array<struct<start:bigint,ord:int,kind:string,end:bigint>>)"))
        for i, r in enumerate(rules)]))
    # Candidate texts only, copies as one: with large inputs Spark's runtime Bloom filter prunes the scan.
    verified = texts.where("body IS NOT NULL").dropDuplicates(["text_key"]).join(
        found, "text_key").select(
        "text_key", F.sort_array(spans).alias("secret_spans")).where(
        F.size("secret_spans") > 0)
    key = fresh(docs, "secret_text_key")
    verified = materialise(verified, "secrets").withColumnRenamed("text_key", key)
    return docs.withColumn(key, F.sha2(text, 256)).join(verified, key, "left").drop(
        key).withColumn("secret_spans", F.coalesce(
            "secret_spans",
            F.expr("CAST(array() AS array<struct<start:bigint,ord:int,kind:string,end:bigint>>)")))
