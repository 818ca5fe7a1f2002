"""Secrets by regular expressions behind a trigram inverted index. DataFrame functions only."""

from __future__ import annotations

from dataclasses import dataclass
from re import _constants as kinds
from re import _parser as regex_parser

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import free_names

#: Beyond so many literal alternatives a rule counts as one without mandatory trigrams and is scanned for everywhere.
MOST_ALTERNATIVES = 64


@dataclass(frozen=True)
class Rule:
    """Matches of ``pattern``, leftmost and without overlaps, of which those stay whose ``group`` has ``least`` characters."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1


# What the base rules are defined as.
BASE_RULES = (
    Rule(
        "assign",
        r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        group=2, least=8,
    ),
    Rule("access", r"AKIA[A-Z0-9]+", least=16),
    Rule("hex", r"[0-9a-f]{32,}", least=32),
)
#: Rules beyond the base: headers of private keys, chat tokens.
MORE_RULES = (
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("chat", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
)
RULES = BASE_RULES + MORE_RULES

FINDING = "struct<kind:string,start:int,end:int>"


def trigram_query(pattern: str) -> list[frozenset[str]] | None:
    """Alternatives, each a set of trigrams that every match of it holds in lower case; None if one has no trigram.

    ``[Tt]`` counts as one letter, optional parts as two alternatives, everything else that is not
    literal as a gap.
    """
    def joined(left, right):
        out = [(*a[:-1], a[-1] + b[0], *b[1:]) for a in left for b in right]
        return out if len(out) <= MOST_ALTERNATIVES else [("", "")]

    def pieces(items):
        out = [("",)]
        for op, value in items:
            out = joined(out, one(op, value))
        return out

    def one(op, value):
        if op is kinds.LITERAL:
            return [(chr(value).lower(),)]
        if op is kinds.IN:
            letters = {chr(v).lower() if o is kinds.LITERAL else None for o, v in value}
            return [(letters.pop(),)] if len(letters) == 1 and None not in letters else [("", "")]
        if op is kinds.SUBPATTERN:
            return pieces(value[-1])
        if op is kinds.BRANCH:
            out = [a for branch in value[1] for a in pieces(branch)]
            return out if len(out) <= MOST_ALTERNATIVES else [("", "")]
        if op is kinds.MAX_REPEAT:
            low, high, what = value
            if (low, high) == (0, 1):
                return [("",), *pieces(what)]
            return [(*a, "") for a in pieces(what)] if low else [("", "")]
        return [("", "")]

    queries = []
    for alternative in pieces(regex_parser.parse(pattern)):
        grams = frozenset(run[i:i + 3] for run in alternative for i in range(len(run) - 2))
        if not grams:
            return None
        queries.append(grams)
    return list(dict.fromkeys(queries))


def postings(docs: DataFrame, trigrams: list[str], text: str = "text", key: str = "doc_id") -> DataFrame:
    """(trigram number, key) of every listed trigram that occurs in a text, in lower case."""
    low = docs.select(F.col(key).alias("key"), F.lower(text).alias("low"))
    present = F.filter(
        F.array(*[F.when(F.contains("low", F.lit(t)), F.lit(n)) for n, t in enumerate(trigrams)]),
        lambda n: n.isNotNull(),
    )
    return low.select(F.explode(present).alias("trigram"), "key")


def candidates(docs: DataFrame, rules: tuple[Rule, ...], text: str = "text", key: str = "doc_id") -> DataFrame:
    """(key, indexed numbers of rules) for rules with mandatory trigrams: keys in whose postings an alternative is whole.

    The rule numbers come as an array. Postings meet by key, already combined in each task.
    """
    wanted = {n: q for n, rule in enumerate(rules) if (q := trigram_query(rule.pattern)) is not None}
    trigrams = sorted({t for q in wanted.values() for alternative in q for t in alternative})
    at = {t: n for n, t in enumerate(trigrams)}
    words = -(-len(trigrams) // 62)
    lists = postings(docs, trigrams, text, key)
    met = lists.groupBy("key").agg(*[
        F.bit_or(F.when(F.floor(F.col("trigram") / 62) == w, F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("trigram") % 62))
                 .otherwise(F.lit(0).cast("bigint"))).alias(f"bits{w}")
        for w in range(words)
    ])

    def whole(alternative):
        masks = [sum(1 << at[t] % 62 for t in alternative if at[t] // 62 == w) for w in range(words)]
        tests = [F.col(f"bits{w}").bitwiseAND(F.lit(m)) == m for w, m in enumerate(masks) if m]
        out = tests[0]
        for t in tests[1:]:
            out = out & t
        return out

    hit = []
    for n, query in wanted.items():
        any_of = whole(query[0])
        for alternative in query[1:]:
            any_of = any_of | whole(alternative)
        hit.append(F.when(any_of, F.lit(n)))
    found = F.filter(F.array(*hit), lambda n: n.isNotNull())
    return met.select("key", found.alias("rules")).where(F.size("rules") > 0)


def _matches(text: Column, number: int, rule: Rule) -> Column:
    """Kept matches as (start, rule number, end) in code points: gaps and matches, in turn, make up the text."""
    pattern = F.lit(rule.pattern)
    step = F.arrays_zip(
        F.transform(F.split(text, rule.pattern, -1), F.length).alias("gap"),
        F.transform(F.regexp_extract_all(text, pattern, F.lit(0)), F.length).alias("hit"),
        F.transform(F.regexp_extract_all(text, pattern, F.lit(rule.group)), F.length).alias("part"),
    )
    empty = F.array().cast("array<struct<start:int,rule:int,end:int>>")
    walked = F.aggregate(
        F.filter(step, lambda x: x["hit"].isNotNull()),
        F.struct(F.lit(0).alias("at"), empty.alias("out")),
        lambda acc, x: F.struct(
            (acc["at"] + x["gap"] + x["hit"]).alias("at"),
            F.when(x["part"] >= rule.least, F.concat(acc["out"], F.array(F.struct(
                (acc["at"] + x["gap"]).alias("start"), F.lit(number).alias("rule"),
                (acc["at"] + x["gap"] + x["hit"]).alias("end"),
            )))).otherwise(acc["out"]).alias("out"),
        ),
    )
    return walked["out"]


def scan(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Give each row ``findings``: (kind, start, end) of every secret, by start and then by the rules' order.

    Positions are code points, ends exclusive. A null or empty text has no findings. Repeated
    rows each get theirs, and rows without a key too. A column ``findings`` of the input is
    replaced, all others stay.

    Rules with mandatory trigrams run only where the index lets them; the others, such as ``hex``,
    run over every text. Postings hold at most one entry for each trigram and key. A match list
    is built row by row, in time that grows with the square of one text's matches.
    """
    own = [c for c in docs.columns if c != "findings"]
    indexed = [n for n, rule in enumerate(rules) if trigram_query(rule.pattern) is not None]
    whole, met, may_fit = free_names(docs, "whole", "met", "may_fit")
    rows = docs.select(*own, F.coalesce(F.col(text), F.lit("")).alias(whole))
    if indexed:
        hits = candidates(docs, rules, text, key).select(F.col("key").alias(met), F.col("rules").alias(may_fit))
        rows = rows.join(hits, F.col(key).eqNullSafe(F.col(met)), "left")
    nothing = F.array().cast("array<struct<start:int,rule:int,end:int>>")
    found = []
    for n, rule in enumerate(rules):
        may = F.array_contains(may_fit, n) if n in indexed else F.lit(True)
        found.append(F.when(may & F.col(whole).rlike(rule.pattern), _matches(F.col(whole), n, rule)).otherwise(nothing))
    ordered = F.array_sort(F.flatten(F.array(*found)))
    names = F.array(*[F.lit(r.kind) for r in rules])
    return rows.select(*own, F.transform(ordered, lambda f: F.struct(
        names[f["rule"]].alias("kind"), f["start"].alias("start"), f["end"].alias("end")
    )).alias("findings"))


def spelled(findings: Column) -> Column:
    """``kind:start:end`` of each finding, joined by commas."""
    return F.array_join(F.transform(findings, lambda f: F.concat_ws(":", f["kind"], f["start"], f["end"])), ",")
