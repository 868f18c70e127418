import random

import pytest
from pyspark.errors import PythonException
from pyspark.sql import functions as F

from tidemark.operators import batching as B
from tidemark.operators.age_batches import batches_by_size_or_age, open_batches
from tidemark.operators.running import arrival_order, running_totals

MESSAGE = "partition_id string, sequence_number bigint, offset string, arrival bigint"


def numbers(rows, column):
    return {(r["k"], r["arrival"]): r[column] for r in rows}


def brute_force(rows, size, wait, start=None):
    """The batch number of each message, by the definition: one message after the other."""
    state, found = {}, {}
    for key, arrival, t in sorted(rows, key=lambda r: r[1]):
        opened, count, batch = state.get(key, (t if start is None else start, 0, 0))
        found[key, arrival] = batch
        count += 1
        closes = count >= size or t - opened >= wait
        state[key] = (t, 0, batch + 1) if closes else (opened, count, batch)
    return found


def random_stream(seed, n, steps):
    rng = random.Random(seed)
    t, rows = 0, []
    for i in range(n):
        t += rng.choice(steps)
        rows.append((rng.choice("aaab"), 3 * i + rng.randrange(3), t))
    return rows


def frame(spark, rows, at):
    timed = [(k, a, at(t)) for k, a, t in rows]
    return spark.createDataFrame(timed, "k string, arrival bigint, t timestamp_ntz").repartition(4)


@pytest.mark.parametrize("cell_bits", [1, 3, 16])
def test_running_totals(spark, cell_bits):
    rng = random.Random(cell_bits)
    rows = [("hot" if i % 3 else f"k{i % 5}", a, rng.randrange(100)) for i, a in enumerate(rng.sample(range(-500, 9000), 400))]
    df = spark.createDataFrame(rows, "k string, arrival bigint, v bigint").repartition(4)
    found = running_totals(df, ["k"], "arrival", {"n": F.lit(1), "total": F.col("v")}, cell_bits).collect()
    assert len(found) == len(rows)
    sums = {}
    expected = {}
    for k, a, v in sorted(rows, key=lambda r: r[1]):
        n, s = sums.get(k, (0, 0))
        sums[k] = expected[k, a] = (n + 1, s + v)
    assert {(r.k, r.arrival): (r.n, r.total) for r in found} == expected


def test_running_totals_without_keys(spark):
    df = spark.range(0, 1000, 1, 4).select(F.col("id").alias("arrival"))
    found = running_totals(df, [], "arrival", {"n": F.lit(1)}, cell_bits=4).collect()
    assert all(r.n == r.arrival + 1 for r in found)


@pytest.mark.parametrize("size", [1, 3, 1000])
def test_batches_by_size(spark, at, size):
    rows = random_stream(size, 300, [1])
    found = B.batches_by_size(frame(spark, rows, at), ["k"], size=size, cell_bits=4).collect()
    assert numbers(found, "batch_no") == brute_force(rows, size, float("inf"))


def test_thousand_messages_are_one_batch(spark):
    df = spark.range(1000).select(F.lit("a").alias("k"), F.col("id").alias("arrival"))
    assert [r[0] for r in B.batches_by_size(df, ["k"]).select("batch_no").distinct().collect()] == [0]


@pytest.mark.parametrize(
    "size, wait, steps",
    [
        (5, 20, [0, 0, 1, 1, 2, 5]),
        (7, 6, [0, 0, 1, 3, 30]),
        (1, 100, [1]),
        (4, 0, [0, 1]),
        (300, 9, [0, 1, 1, 2]),
        (3, 1000000, [1]),
    ],
)
def test_batches_by_size_or_age(spark, at, size, wait, steps):
    rows = random_stream(size * 31 + wait, 400, steps)
    chunks = {"chunk_rows": 24, "fan": 3, "cell_bits": 5}
    found = batches_by_size_or_age(frame(spark, rows, at), ["k"], clock="t", size=size, max_wait_seconds=wait, **chunks)
    collected = found.collect()
    assert len(collected) == len(rows)
    assert numbers(collected, "batch_no") == brute_force(rows, size, wait)


def test_age_batches_in_one_chunk(spark, at):
    rows = random_stream(5, 300, [0, 1, 2, 9])
    found = batches_by_size_or_age(frame(spark, rows, at), ["k"], clock="t", size=6, max_wait_seconds=10).collect()
    assert numbers(found, "batch_no") == brute_force(rows, 6, 10)


def test_age_counts_from_the_last_close(spark, at):
    # The message after the idle time closes its batch alone; an age of exactly the limit closes.
    rows = [("a", 1, 0), ("a", 2, 9), ("a", 3, 10), ("a", 4, 100), ("a", 5, 101), ("a", 6, 110)]
    found = batches_by_size_or_age(frame(spark, rows, at), ["k"], clock="t", size=100, max_wait_seconds=10).collect()
    assert [numbers(found, "batch_no")["a", i] for i in range(1, 7)] == [0, 0, 0, 1, 2, 2]


def test_age_batches_from_a_start_time(spark, at):
    rows = random_stream(11, 200, [0, 1, 4])
    found = batches_by_size_or_age(
        frame(spark, rows, at), ["k"], clock="t", size=8, max_wait_seconds=12, start_time=str(at(-30)), chunk_rows=20, fan=2
    ).collect()
    assert numbers(found, "batch_no") == brute_force(rows, 8, 12, start=-30)


def test_age_batches_without_keys(spark, at):
    rows = [("a", a, t) for _, a, t in random_stream(3, 150, [0, 1, 3])]
    df = frame(spark, rows, at).drop("k")
    found = batches_by_size_or_age(df, [], clock="t", size=9, max_wait_seconds=8, chunk_rows=20, fan=2).collect()
    assert {("a", r.arrival): r.batch_no for r in found} == brute_force(rows, 9, 8)


def test_null_keys_are_refused(spark, at):
    with pytest.raises(Exception, match="must not be NULL"):
        batches_by_size_or_age(frame(spark, [(None, 1, 0), ("a", 2, 1)], at), ["k"], clock="t").collect()


def test_zoned_clock(spark, at):
    rows = random_stream(8, 60, [0, 1, 3])
    df = frame(spark, rows, at).withColumn("t", F.col("t").cast("timestamp"))
    found = batches_by_size_or_age(df, ["k"], clock="t", size=9, max_wait_seconds=8, start_time=str(at(-5))).collect()
    assert numbers(found, "batch_no") == brute_force(rows, 9, 8, start=-5)


@pytest.mark.parametrize("size, wait", [(7, 12), (3, 1000), (50, 5)])
def test_cut_in_parts_equals_one_cut(spark, at, size, wait):
    rows = random_stream(size, 240, [0, 1, 1, 4, 20]) + [("late", 10_000 + i, 5000 + 3 * i) for i in range(9)]
    parts = [rows[:50], rows[50:51], rows[51:160], rows[160:]]
    found, opened = {}, None
    for part in parts:
        df = frame(spark, part, at)
        cut = batches_by_size_or_age(
            df, ["k"], clock="t", size=size, max_wait_seconds=wait, chunk_rows=20, fan=2, opened=opened
        )
        found.update(numbers(cut.collect(), "batch_no"))
        state = open_batches(cut, df, ["k"], "t", opened).collect()
        opened = spark.createDataFrame(state, "k string, opened_at timestamp_ntz, pending bigint, batch_no bigint")
    assert found == brute_force(rows, size, wait)


def test_clock_that_runs_backwards_is_refused(spark, at):
    df = frame(spark, [("a", 1, 5), ("a", 2, 4)], at)
    with pytest.raises(PythonException, match="runs backwards"):
        batches_by_size_or_age(df, ["k"], clock="t").collect()


def test_last_arrival_is_not_the_highest(spark):
    rows = [("0", s, str(s * 2), i) for i, s in enumerate([100, 105, 102, 104, 103])]
    df = spark.createDataFrame(rows, MESSAGE)
    assert B.last_arrivals(df, ["partition_id"], ["sequence_number"]).first().sequence_number == 103
    top = B.batch_waterlevels(df, ["partition_id"]).first()
    assert (top.sequence_number, top.offset, top.waterlevel) == (105, "210", 210)
    assert B.first_arrivals(df, ["partition_id"], ["sequence_number"]).first().sequence_number == 100


def test_first_arrival_wins_ties(spark):
    rows = [("0", 7, "late", 3), ("0", 7, "early", 1), ("0", 7, "middle", 2)]
    df = spark.createDataFrame(rows, MESSAGE).repartition(3)
    row = B.batch_waterlevels(df, ["partition_id"]).first()
    assert (row.offset, row.waterlevel) == ("early", 7)


def test_several_partitions(spark):
    rows = [(p, start + i, str(start + i), 3 * i + int(p)) for p, start in [("0", 100), ("1", 200), ("2", 150)] for i in range(3)]
    found = B.last_arrivals(spark.createDataFrame(rows, MESSAGE), ["partition_id"], ["sequence_number"]).collect()
    assert {r.partition_id: r.sequence_number for r in found} == {"0": 102, "1": 202, "2": 152}


def test_redelivered_messages(spark):
    rows = [("0", i % 5, f"copy {i}", i) for i in range(50)] + [("1", 0, "hot", 100 + i) for i in range(40)]
    kept = B.drop_redelivered(spark.createDataFrame(rows, MESSAGE).repartition(4), ["partition_id", "sequence_number"])
    assert kept.columns == ["partition_id", "sequence_number", "offset", "arrival"]
    assert sorted(map(tuple, kept.collect())) == [("0", i, f"copy {i}", i) for i in range(5)] + [("1", 0, "hot", 100)]


def test_arrival_order_of_tied_times(spark):
    rows = [(i % 3 and 7, (i * 37) % 200) for i in range(200)]
    ordered = arrival_order(spark.createDataFrame(rows, "t bigint, s bigint").repartition(5), ["t", "s"])
    found = ordered.orderBy("arrival").collect()
    assert [(r.t, r.s) for r in found] == sorted(rows)
    assert len({r.arrival for r in found}) == 200
