import pytest
from pyspark.sql import functions as F

from tidemark.operators import failures as T
from tidemark.session import written

SCHEMA = "ts bigint, error_type string, message string"


@pytest.mark.parametrize(
    "error, retry",
    [
        (("TimeoutError", "Connection timed out after 30 seconds"), True),
        (("HttpError", "503 Service Unavailable"), True),
        (("HttpError", "Error 429: Too Many Requests"), True),
        (("IoError", "resource temporarily locked"), True),
        (("OSError", "Temporary DNS resolution failure"), True),
        (("PoolError", "connection pool exhausted"), True),
        (("PermissionError", "Invalid credentials: Access denied"), False),
        (("HttpError", "401 while connection was open"), False),
        (("SchemaError", "schema mismatch on column a"), False),
        (("HttpError", "404"), False),
        (("ParserError", "syntax error near FROM"), False),
        (("QuotaError", "Quota exceeded"), False),
        (("ValueError", "Some error"), False),
    ],
)
def test_decisions_on_cluster_and_driver_agree(spark, error, retry):
    row = spark.createDataFrame([(1, *error)], SCHEMA).select(T.decision(F.col("error_type"), F.col("message")).alias("d")).first().d
    raised = type(error[0], (Exception,), {})(error[1])
    rule = T.decide(raised)
    assert row.should_retry is retry and rule.should_retry is retry
    assert (row.reasoning, row.confidence) == (rule.reasoning, rule.confidence)


def test_unknown_errors_stop(spark):
    rows = spark.createDataFrame([(1, "ValueError", "Some error")], SCHEMA)
    d = T.classify_failures(rows).first()
    assert (d.should_retry, d.confidence, d.suggested_wait_seconds) == (False, 0.0, 1)


def test_interrupts_are_never_retried():
    assert T.decide(KeyboardInterrupt("connection timeout")).should_retry is False


def test_signature_is_classified_once_on_its_first_message(spark):
    long = "x" * 100
    rows = [(2, "E", long + " access denied"), (1, "E", long + " timeout"), (3, "E", long), (4, "F", "timeout")]
    failures = spark.createDataFrame(rows, SCHEMA).repartition(4)
    found = T.classify_failures(failures).collect()
    assert len(found) == 4 and all(r.should_retry for r in found)
    stats = T.decision_stats(failures).first()
    assert (stats.analyses, stats.cached_decisions, stats.cache_hits) == (2, 2, 2)
    assert (stats.retry_decisions, stats.stop_decisions, stats.hit_rate) == (4, 0, 0.5)


def test_own_rules_come_first(spark):
    rows = spark.createDataFrame([(1, "ValueError", "Some error")], SCHEMA)
    mine = [T.Rule("some error", True, "known to pass"), *T.RULES]
    assert T.classify_failures(rows, rules=mine).first().reasoning == "known to pass"


def test_hot_signature_beyond_the_broadcast_bound(spark, monkeypatch):
    rows = spark.range(300).selectExpr(
        "id AS ts", "'E' AS error_type", "CASE WHEN id % 3 > 0 THEN 'timeout' ELSE concat('quota ', id) END AS message"
    )
    expected = sorted(map(str, T.classify_failures(rows).collect()))
    monkeypatch.setattr(T.lookup_join, "__defaults__", ("left", None, 0))
    assert sorted(map(str, T.classify_failures(rows).collect())) == expected


@pytest.mark.parametrize(
    "message, kind",
    [
        ("DefaultAzureCredential failed to retrieve a token: unauthorized", "credential"),
        ("Caller is not authorized", "permission"),
        ("status 403", "permission"),
        ("disk full", "other"),
    ],
)
def test_error_kind(spark, message, kind):
    assert spark.createDataFrame([(message,)], "m string").select(T.error_kind(F.col("m"))).first()[0] == kind


@pytest.mark.parametrize(
    "pattern, literals",
    [
        ("timed out|timeout", ["timed out", "timeout"]),
        (r"\b503\b|service unavailable", ["503", "service unavailable"]),
        (r"pool exhaust(ed|ion)", ["pool exhaust"]),
        (r"erro?r code", ["r code"]),
        (r"ab+c deadlock", ["c deadlock"]),
        (r"x{2,3}quota", ["quota"]),
        (r"key: \"k\" = 7\}$", ['key: "k" = 7}']),
        (r"[abc]+locked", ["locked"]),
        (r"(timeout)", None),
        (r"timeout|\d+", None),
        (r"(?i)timeout", None),
        (r"a.b.c", None),
        ("", None),
        (r"abc\Qd|e\E", None),
        (r"time[out", None),
    ],
)
def test_required_literals(pattern, literals):
    assert T.required_literals(pattern) == literals


def test_a_match_always_holds_a_required_literal():
    """Every built-in rule, and patterns made of pieces, on texts made of their letters."""
    import random
    import re

    draw = random.Random(2)
    pieces = ["lock", "ed", "time", "out", "a?", "b*", "c+", "d{0,2}", "(x|y)", "[pq]", ".", r"\d", r"\.", "|", "quota"]
    words = ["lock", "ed", "time", "out", "a", "b", "c", "d", "x", "p", "1", ".", "quota", " "]
    patterns = [r.pattern for r in T.RULES] + ["".join(draw.choices(pieces, k=draw.randrange(1, 6))) for _ in range(400)]
    matched = 0
    for pattern in patterns:
        literals = T.required_literals(pattern)
        if literals is None:
            continue
        for _ in range(60):
            text = "".join(draw.choices(words, k=draw.randrange(1, 8)))
            if re.search(pattern, text):
                matched += 1
                assert any(x in text for x in literals), (pattern, text, literals)
    assert matched > 300


RULE_SCHEMA = "priority int, pattern string, should_retry boolean, confidence double, reasoning string"


def errors(spark, *messages):
    return spark.createDataFrame([(i, "E", m) for i, m in enumerate(messages)], SCHEMA)


def test_rule_tables_decide_by_priority(spark):
    rules = [(2, "disk full", False, 0.8, "disk"), (1, "disk (full|slow)", True, 0.7, "second glance"), (1, r"\d\d", True, 0.6, "digits"), (0, None, True, 1.0, "never"), (5, "^e: x", False, 0.4, "x")]
    table = spark.createDataFrame(rules, RULE_SCHEMA)
    found = {r.message: (r.should_retry, r.reasoning, r.confidence, r.suggested_wait_seconds) for r in T.classify_failures(errors(spark, "DISK FULL", "disk full 42", "x", "nothing", "x"), rules=table).collect()}
    assert found["DISK FULL"] == (True, "second glance", 0.7, 2)
    assert found["disk full 42"] == (True, "digits", 0.6, 2)  # of two rules of one priority, the smaller pattern
    assert found["x"] == (False, "x", 0.4, 2)
    assert (found["nothing"][0], found["nothing"][2]) == (False, 0.0)


def test_a_table_of_the_built_in_rules_decides_as_they_do(spark):
    rows = errors(spark, "Connection timed out", "503 Service Unavailable", "401 while connection was open", "404", "Some error", "Quota exceeded", "deadlock", "misconfigured")
    table = T.rule_table(spark)
    columns = ["message", "should_retry", "reasoning", "confidence", "suggested_wait_seconds"]
    one, two = (sorted(map(tuple, T.classify_failures(rows, rules=r).select(*columns).collect())) for r in (None, table))
    assert one == two
    assert T.decision_stats(rows, rules=table).first() == T.decision_stats(rows).first()


def test_many_rules_meet_few_errors(spark):
    rules = spark.range(5000).selectExpr("cast(id AS int) AS priority", "concat('code-', id, ' failed') AS pattern", "id % 2 = 0 AS should_retry", "0.5D AS confidence", "concat('rule ', id) AS reasoning")
    found = {r.message: r.reasoning for r in T.classify_failures(errors(spark, "code-7 failed", "code-77 failed", "code-4999 FAILED!", "code-9"), rules=rules).collect()}
    assert found == {"code-7 failed": "rule 7", "code-77 failed": "rule 77", "code-4999 FAILED!": "rule 4999", "code-9": "no rule matched; stopping for safety"}


def test_grams_of_literals_are_merged_without_sorting_them(spark, monkeypatch):
    """A rule has as many grams as its literals are long: none of them is sorted, nor are they dealt by grams that all rules have."""
    plans = []
    monkeypatch.setattr(T, "written", lambda df, label: plans.append(df._jdf.queryExecution().executedPlan().toString()) or written(df, label))
    rules = spark.range(3000).selectExpr("cast(id AS int) AS priority", "concat('customer ', id, ' is gone') AS pattern", "true AS should_retry", "0.5D AS confidence", "concat('rule ', id) AS reasoning")
    rows = errors(spark, "customer 12 is gone", "Customer 2999 is gone", "customer 3000 is gone", "gone", "", None)
    found = T.signature_decisions(rows, rules=rules)
    assert {r.signature: r.reasoning for r in found.collect() if r.confidence == 0.5} == {"E:customer 12 is gone": "rule 12", "E:Customer 2999 is gone": "rule 2999"}
    of_literals = [p for p in [*plans, found._jdf.queryExecution().toString()] if "literal#" in p]
    aggregates = [line for p in of_literals for line in p.splitlines() if "Aggregate(key" in line and "literal#" in line.split("]")[0]]
    assert aggregates and not any("SortAggregate" in line for line in aggregates)


def test_rarest_grams(spark):
    grams = spark.createDataFrame([(i, g) for i, g in enumerate(["abc", "abc", "abc", "bcd", "bcd", "xyz"])], "signature int, gram string")
    literals = spark.createDataFrame([("abcd",), ("abcd",), ("abc",), ("abcde",), ("xyz",)], "literal string")
    name = {r["gram"]: r["name"] for r in grams.select("gram", T._gram_name(F.col("gram")).alias("name")).distinct().collect()}
    assert {tuple(r) for r in T._rarest(literals, grams).collect()} == {("abcd", name["bcd"]), ("abc", name["abc"]), ("xyz", name["xyz"])}


def test_no_errors_and_no_rules(spark):
    table = T.rule_table(spark, [])
    assert T.classify_failures(errors(spark, "a").limit(0), rules=T.rule_table(spark)).count() == 0
    assert T.classify_failures(errors(spark, "timeout"), rules=table).first().confidence == 0.0
