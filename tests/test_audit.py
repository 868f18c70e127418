import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators import audit as A
from tidemark.operators.percentiles import exact_percentiles

SCHEMA = (
    "mapping string, batch_id bigint, started timestamp_ntz, ended timestamp_ntz, messages bigint, partitions bigint, "
    "success boolean, checkpoints_updated bigint, error string"
)


@pytest.fixture
def audit(spark, at):
    rows = [
        ("a->x", 0, at(0), at(2), 6, 3, True, 3, None),
        ("a->x", 1, at(2), at(5), 4, 2, True, 2, None),
        ("a->x", 2, at(5), at(9), 100, 2, False, 0, "sink failed"),
        ("b->x", 0, at(1), at(1), 7, 1, True, 1, None),
        ("b->x", 1, at(1), at(1), 3, 1, True, 1, None),
    ]
    return spark.createDataFrame(rows, SCHEMA)


def test_mapping_stats(audit, at):
    found = {r.mapping: r for r in A.mapping_stats(audit).collect()}
    a = found["a->x"]
    assert (a.messages_processed, a.batches_processed, a.batches_failed) == (10, 2, 1)
    assert (a.runtime_seconds, a.last_activity) == (9.0, at(5))
    assert a.messages_per_second == round(10 / 9, 6)
    assert found["b->x"].messages_per_second == 0.0  # no time has passed


def test_rollup_of_two_mappings(audit):
    total = A.stats_rollup(audit).filter("mapping IS NULL").first()
    assert (total.messages_processed, total.batches_processed) == (20, 4)
    assert total.batches_per_second == round(4 / 9, 6)


def test_errors_are_rows(audit, at):
    assert [tuple(r) for r in A.mapping_errors(audit).collect()] == [("a->x", 2, at(9), "sink failed")]


def test_running_totals(audit):
    found = {(r.mapping, r.batch_id): (r.total_messages, r.total_batches) for r in A.with_totals(audit, ["mapping"]).collect()}
    assert found["a->x", 2] == (10, 2) and found["b->x", 1] == (10, 2) and found["a->x", 0] == (6, 1)


def test_health_counts_running_only(spark):
    statuses = spark.createDataFrame([("a", "running"), ("b", "stopped"), ("c", "failed")], "mapping string, status string")
    assert tuple(A.health_rollup(statuses).first()) == (3, 1)


def test_trace_filters(audit):
    assert A.trace_filter(audit, success=False).count() == 1
    assert {r.batch_id for r in A.trace_filter(audit, slower_than_ms=2500, mapping="a->x").collect()} == {1, 2}


def test_checkpoint_success(audit):
    found = {r.mapping: r.checkpoint_success_rate for r in A.checkpoint_success_rates(audit, ["mapping"]).collect()}
    assert found == {"a->x": round(5 / 7, 6), "b->x": 1.0}


def test_error_rate_and_throughput(spark, at):
    rows = [(at(i * 60), "h", "error" if i % 4 == 0 else "ok") for i in range(8)]
    df = spark.createDataFrame(rows, "t timestamp_ntz, hub string, kind string")
    assert A.error_rates(df, ["hub"], F.col("kind") == "error").first().error_rate == 0.25
    windows = A.throughput(df, "t", "5 minutes").orderBy("window_start").collect()
    assert [(r.window_start, r.messages) for r in windows] == [(at(0), 5), (at(300), 3)]


@pytest.mark.parametrize("cells, cell_values", [(4096, 1 << 20), (64, 3), (4, 40)])
def test_exact_percentiles(spark, cells, cell_values):
    rng = random.Random(7)
    groups = {
        "even": [rng.uniform(-5, 5) for _ in range(300)],
        "tail": [10 ** rng.uniform(-3, 9) for _ in range(300)],
        "same": [4.25] * 50,
        "two": [1.0, 2.0],
        "one": [-3.0],
        None: [rng.gauss(0, 1) for _ in range(40)],
        "wide": [-1.7e308, -1e300, 0.0, 1e-320, 1e300, 1.7e308],
        "mostly": [0.0] * 200 + [rng.uniform(0, 1e-6) for _ in range(99)] + [1e12],
    }
    rows = [(g, v) for g, values in groups.items() for v in values] + [("one", None)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(4)
    wanted = {"p0": 0.0, "p50": 0.5, "p95": 0.95, "p99": 0.99, "p100": 1.0}
    found = {r.g: r for r in exact_percentiles(df, ["g"], "v", wanted, cells, cell_values).collect()}
    assert set(found) == set(groups)
    for g, values in groups.items():
        for name, p in wanted.items():
            assert found[g][name] == pytest.approx(np.percentile(values, 100 * p), rel=1e-9, abs=1e-15), (g, name)
