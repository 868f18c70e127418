"""Failure triage: what kind of error, and is it worth another attempt.

Rules are a short list, tried one after the other in one expression, or a table of any size (``priority, pattern, should_retry, confidence,
reasoning``). A table is not tried rule by rule: from each pattern, literals are read of which a match must hold one; the rarest
three characters of each meet the errors' in a join, and only what meets is matched.
"""

from __future__ import annotations

import re
import sys
from dataclasses import dataclass

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.text import error_signature
from tidemark.operators.joins import lookup_join
from tidemark.session import written

# The functions of this module travel to the executors by value, so these need no installed package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Keywords of authentication failures and of missing permissions.
CREDENTIAL_KEYWORDS = [
    "credential",
    "failed to invoke azure cli",
    "failed to retrieve a token",
    "defaultazurecredential failed",
    "authentication unavailable",
]
PERMISSION_KEYWORDS = [
    "unauthorized",
    "not authorized",
    "authenticationerror",
    "permission",
    "access denied",
    "forbidden",
    "401",
    "403",
]
# What a failed run as a whole is searched for.
RUN_PERMISSION_KEYWORDS = ["authenticationerror", "not authorized", "permission", "unauthorized"]


@dataclass(frozen=True)
class Rule:
    """Errors whose lower-cased ``type: message`` matches the pattern get this decision."""

    pattern: str
    should_retry: bool
    reasoning: str
    confidence: float = 0.9
    suggested_wait_seconds: int = 2


# In order of precedence: an error that looks fatal is not retried, whatever else it says.
RULES = [
    Rule(
        r"\b40[13]\b|unauthorized|forbidden|access denied|authenticat|authoriz|permission|credential",
        False,
        "authentication or authorization failure",
    ),
    Rule(r"schema mismatch|constraint", False, "schema mismatch or constraint violation"),
    Rule(r"invalid (data|format|type|value)|typeerror|type error|cannot cast", False, "invalid data format or type"),
    Rule(r"quota", False, "quota exceeded"),
    Rule(r"\b404\b|not found|does not exist", False, "resource not found"),
    Rule(r"syntax error|syntaxerror|parser error", False, "query syntax error"),
    Rule(r"configuration|misconfigured", False, "configuration error"),
    Rule(r"\b400\b|bad request|malformed", False, "malformed request"),
    Rule(r"validation", False, "data validation failure"),
    Rule(r"\b429\b|rate limit|too many requests|throttl", True, "rate limited", suggested_wait_seconds=10),
    Rule(r"\b503\b|temporarily unavailable|service unavailable", True, "service unavailable", suggested_wait_seconds=5),
    Rule(r"\bdns\b|name resolution", True, "name resolution failure"),
    Rule(r"pool exhaust|connection pool", True, "connection pool exhausted", suggested_wait_seconds=5),
    Rule(r"timed out|timeout", True, "network timeout"),
    Rule(r"connection|network", True, "connection failure"),
    Rule(r"locked|busy|deadlock", True, "resource locked or busy"),
    Rule(r"transient", True, "transient database error"),
]

# Seconds to wait where a rule table does not say.
DEFAULT_WAIT = 2
# In doubt, stop.
UNKNOWN = Rule("", False, "no rule matched; stopping for safety", confidence=0.0, suggested_wait_seconds=1)


def says_any(message: Column, keywords: list[str]) -> Column:
    return F.lower(message).rlike("|".join(keywords))


def error_kind(message: Column) -> Column:
    """``credential``, ``permission`` or ``other``; credentials are tested first."""
    return (
        F.when(says_any(message, CREDENTIAL_KEYWORDS), "credential")
        .when(says_any(message, PERMISSION_KEYWORDS), "permission")
        .otherwise("other")
    )


def lacks_permission(message: Column) -> Column:
    """Whether a run ended for want of a permission, by the shorter keyword list."""
    return says_any(message, RUN_PERMISSION_KEYWORDS)


def decision(error_type: Column, message: Column, rules: list[Rule] | None = None) -> Column:
    """Struct with the decision of the first matching rule."""
    text = F.lower(F.concat(error_type, F.lit(": "), message))
    chosen = None
    for rule in RULES if rules is None else rules:
        hit = text.rlike(rule.pattern)
        chosen = F.when(hit, _verdict(rule)) if chosen is None else chosen.when(hit, _verdict(rule))
    return _verdict(UNKNOWN) if chosen is None else chosen.otherwise(_verdict(UNKNOWN))


def _verdict(rule: Rule) -> Column:
    return F.struct(
        F.lit(rule.should_retry).alias("should_retry"),
        F.lit(rule.reasoning).alias("reasoning"),
        F.lit(rule.suggested_wait_seconds).cast("bigint").alias("suggested_wait_seconds"),
        F.lit(rule.confidence).alias("confidence"),
    )


# Characters of a literal that are looked up.
GRAM = 3
# Rules of a table without a literal are tried on every error; more of them than this are refused.
MOST_SCANNED = 500
_TEXT = "_text"


def required_literals(pattern: str) -> list[str] | None:
    """Literals of which every match of a regular expression holds at least one, one for each alternative; None if they cannot be told.

    Reads the pattern from the outside only: groups, classes and anything repeated or optional count as unknown, so a literal is never claimed
    that a match could lack.
    """
    if "(?" in pattern or "\\Q" in pattern:
        return None
    alternatives: list[list[str]] = [[""]]
    depth, i = 0, 0
    while i < len(pattern):
        c, plain = pattern[i], None
        if c == "\\" and i + 1 < len(pattern):
            plain = pattern[i + 1] if not pattern[i + 1].isalnum() else None
            i += 1
        elif c == "[":
            close = pattern.find("]", i + 2 if pattern[i + 1 : i + 2] != "^" else i + 3)
            if close < 0 or "[" in pattern[i + 1 : close] or "\\" in pattern[i + 1 : close]:
                return None
            i = close
        elif c in "()":
            depth += 1 if c == "(" else -1
        elif c in "*?{" and depth == 0:  # what stands before may be missing
            alternatives[-1][-1] = alternatives[-1][-1][:-1]
            i = pattern.find("}", i) if c == "{" else i
            if i < 0:
                return None
        elif c == "|" and depth == 0:
            alternatives.append([""])
            i += 1
            continue
        elif c not in ".^$+|*?{}":
            plain = c
        if plain is not None and depth == 0:
            alternatives[-1][-1] += plain
        else:
            alternatives[-1].append("")
        i += 1
    longest = [max(runs, key=len) for runs in alternatives]
    return longest if depth == 0 and all(len(run) >= GRAM for run in longest) else None


@F.pandas_udf(T.ArrayType(T.StringType()))
def _literals(patterns: pd.Series) -> pd.Series:
    return patterns.map(required_literals)


def _grams(text: Column) -> Column:
    """The distinct runs of three characters of a text."""
    count = F.char_length(text) - GRAM + 1
    places = F.when(count > 0, F.sequence(F.lit(1), count)).otherwise(F.array().cast("array<int>"))
    return F.array_distinct(F.transform(places, lambda i: F.substring(text, i, F.lit(GRAM))))


# Bits of the number that stands for a gram in the lookup. Grams that share one only meet more errors, which then do not hold the literal.
GRAM_BITS = 31


def _gram_name(gram: Column) -> Column:
    return F.xxhash64(gram).bitwiseAND(F.lit((1 << GRAM_BITS) - 1))


def _rarest(literals: DataFrame, grams: DataFrame) -> DataFrame:
    """``literal`` and the name of that of its grams that the fewest texts hold; no row where no text holds one of them.

    The grams of a literal are merged as they are read: count and name are one number, whose minimum needs neither a sort nor a row for each
    gram in a shuffle. The rules of a table may have most of their grams in common, so the counts are brought to them by ``lookup_join``.
    """
    frequent = grams.groupBy("gram").agg(F.count("*").alias("texts"))
    sought = literals.select("literal", F.explode(_grams(F.col("literal"))).alias("gram"))
    counted = lookup_join(sought, frequent, ["gram"], "left", "literal")
    texts = F.coalesce("texts", F.lit(0)).cast("bigint")
    best = counted.groupBy("literal").agg(F.min(F.shiftleft(texts, GRAM_BITS).bitwiseOR(_gram_name(F.col("gram")))).alias("best"))
    # A literal whose rarest gram no text holds asks for nothing.
    return best.where(F.shiftright("best", GRAM_BITS) > 0).select("literal", F.col("best").bitwiseAND(F.lit((1 << GRAM_BITS) - 1)).alias("gram"))


def _by_table(texts: DataFrame, rules: DataFrame) -> DataFrame:
    """``signature`` and the verdict of the first matching rule of a table for ``texts(signature, _text)``; no row where none matches."""
    wait = F.col("suggested_wait_seconds") if "suggested_wait_seconds" in rules.columns else F.lit(DEFAULT_WAIT)
    verdict = F.struct("should_retry", "reasoning", wait.cast("bigint").alias("suggested_wait_seconds"), F.col("confidence").cast("double").alias("confidence"))
    # Of rules with one priority the smaller pattern comes first.
    known = written(rules.where("pattern IS NOT NULL").select(F.struct(F.col("priority").cast("bigint").alias("priority"), "pattern").alias("rule"), "pattern", verdict.alias("verdict"), _literals("pattern").alias("literals")), "triage-rules")
    texts = written(texts, "triage-texts")
    grams = texts.select("signature", F.explode(_grams(F.col(_TEXT))).alias("gram"))
    asked = known.where("literals IS NOT NULL").select("rule", F.explode("literals").alias("literal"))
    wanted = asked.join(written(_rarest(asked.select("literal"), grams), "triage-grams"), "literal")
    met = grams.select("signature", _gram_name(F.col("gram")).alias("gram")).join(wanted, "gram").join(texts, "signature").where(F.contains(_TEXT, "literal")).select("signature", "rule", _TEXT).distinct()
    hits = met.where(F.expr(f"{_TEXT} rlike rule.pattern")).select("signature", "rule")

    scanned = [r["pattern"] for r in known.where("literals IS NULL").select("pattern").distinct().limit(MOST_SCANNED + 1).collect()]
    if len(scanned) > MOST_SCANNED:
        raise ValueError(f"more than {MOST_SCANNED} rules without a literal of {GRAM} characters")
    if scanned:
        found = F.array_compact(F.array(*[F.when(F.col(_TEXT).rlike(p), F.lit(p)) for p in scanned]))
        matched = texts.select("signature", F.explode(found).alias("pattern"))
        hits = hits.unionByName(matched.join(known.where("literals IS NULL").select("pattern", "rule"), "pattern").select("signature", "rule"))
    first = written(hits.groupBy("signature").agg(F.min("rule").alias("rule")), "triage-hits")
    # Joined before the verdicts of equal rules are merged, so that only those of rules that decide are.
    return first.join(known.select("rule", "verdict"), "rule").groupBy("signature").agg(F.first("verdict").alias("_d"))


def signature_decisions(failures: DataFrame, order: str = "ts", rules: list[Rule] | DataFrame | None = None) -> DataFrame:
    """One decision per error signature, made on its first occurrence.

    Failures with one signature are merged before the shuffle, so an error repeated a billion
    times is classified once and moves one row per input partition. Rules given as a table have ``priority``
    (the smallest match decides), ``pattern``, ``should_retry``, ``confidence``, ``reasoning`` and, if wanted, ``suggested_wait_seconds``; a rule with a
    NULL pattern never matches.
    """
    signature = error_signature(F.col("error_type"), F.col("message"))
    first = F.min(F.struct(order, "error_type", "message"))
    known = failures.groupBy(signature.alias("signature")).agg(first.alias("_first"), F.count("*").alias("occurrences"))
    kind, message = F.col("_first.error_type"), F.col("_first.message")
    if isinstance(rules, DataFrame):
        known = written(known, "signatures")
        found = _by_table(known.select("signature", F.lower(F.concat(kind, F.lit(": "), message)).alias(_TEXT)), rules)
        decided = known.join(found, "signature", "left").withColumn("_d", F.coalesce("_d", _verdict(UNKNOWN)))
    else:
        decided = known.withColumn("_d", decision(kind, message, rules))
    return decided.select("signature", "occurrences", "_d.*")


def rule_table(spark: SparkSession, rules: list[Rule] | None = None, first: int = 0) -> DataFrame:
    """A list of rules as a table; their order becomes the priority, from ``first`` on."""
    rows = [(first + i, r.pattern, r.should_retry, r.confidence, r.reasoning, r.suggested_wait_seconds) for i, r in enumerate(RULES if rules is None else rules)]
    return spark.createDataFrame(rows, "priority bigint, pattern string, should_retry boolean, confidence double, reasoning string, suggested_wait_seconds bigint")


def classify_failures(
    failures: DataFrame, order: str = "ts", rules: list[Rule] | DataFrame | None = None, spread: str | None = None
) -> DataFrame:
    """Failures with the decision of their signature and whether it was already known."""
    decisions = signature_decisions(failures, order, rules).drop("occurrences")
    marked = failures.withColumn("signature", error_signature(F.col("error_type"), F.col("message")))
    return lookup_join(marked, decisions, ["signature"], "left", spread or order)


def decision_stats(failures: DataFrame, order: str = "ts", rules: list[Rule] | DataFrame | None = None) -> DataFrame:
    """Analyses made, decisions reused, verdicts, mean confidence and hit rate."""
    known = signature_decisions(failures, order, rules)
    n = F.sum("occurrences")
    return known.agg(
        F.count("*").alias("analyses"),
        F.count("*").alias("cached_decisions"),
        F.coalesce(n - F.count("*"), F.lit(0)).cast("bigint").alias("cache_hits"),
        F.coalesce(F.sum(F.when(F.col("should_retry"), F.col("occurrences"))), F.lit(0)).alias("retry_decisions"),
        F.coalesce(F.sum(F.when(~F.col("should_retry"), F.col("occurrences"))), F.lit(0)).alias("stop_decisions"),
        F.round(F.sum(F.col("confidence") * F.col("occurrences")) / n, 6).alias("average_confidence"),
        F.round((n - F.count("*")) / n, 6).alias("hit_rate"),
    )


def decide(error: BaseException, rules: list[Rule] | None = None) -> Rule:
    """The same decision for one exception raised on the driver.

    Anything that is not an ``Exception``, such as an interrupt, is never retried.
    """
    if not isinstance(error, Exception):
        return UNKNOWN
    text = f"{type(error).__name__}: {error}".lower()
    return next((r for r in (RULES if rules is None else rules) if re.search(r.pattern, text)), UNKNOWN)
