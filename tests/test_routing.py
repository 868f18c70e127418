import pytest

from tidemark import schemas
from tidemark.operators import routing as R


@pytest.fixture
def sources(spark):
    rows = [
        ("SOURCE_1", 1, "ns", "topic1", "$Default"),
        ("SOURCE_2", 2, "ns", "topic2", "$Default"),
        ("SOURCE_3", 3, "ns", "topic3", " "),
    ]
    return spark.createDataFrame(rows, schemas.SOURCES)


@pytest.fixture
def targets(spark):
    rows = [
        ("TARGET_1", 1, "lake", "ingest", "table1", 1000),
        ("TARGET_3", 3, "lake", None, "table3", 1000),
        ("TARGET_4", 4, "lake", "ingest", "table4", 1000),
    ]
    return spark.createDataFrame(rows, schemas.TARGETS)


def test_matching_numbers(sources, targets):
    rows = R.match_routes(sources, targets).collect()
    assert [(r.mapping, r.name, r.table_name) for r in rows] == [("SOURCE_1->TARGET_1", "topic1", "table1")]


def test_unmatched_on_both_sides(sources, targets):
    found = {tuple(r) for r in R.unmatched(sources, targets).collect()}
    assert found == {("source", "SOURCE_2"), ("source", "SOURCE_3"), ("target", "TARGET_4")}


def test_source_without_group(sources):
    assert [r.source_key for r in R.incomplete_sources(sources).collect()] == ["SOURCE_3"]
    with pytest.raises(Exception, match="consumer group is required for SOURCE_3"):
        R.require_complete_sources(sources).collect()


def test_mappings_that_point_nowhere(spark, sources, targets):
    mappings = spark.createDataFrame(
        [("SOURCE_1", "TARGET_1"), ("SOURCE_9", "TARGET_1"), ("SOURCE_2", "TARGET_9")], "source_key string, target_key string"
    )
    found = {tuple(r) for r in R.invalid_mappings(mappings, sources, targets).collect()}
    assert found == {("SOURCE_9", "TARGET_1", "source"), ("SOURCE_2", "TARGET_9", "target")}


def test_counts(sources, targets):
    assert tuple(R.configuration_counts(sources, targets).first()) == (3, 2, 1)


def test_fan_in(spark):
    sources = spark.createDataFrame([("A", 1, "n", "h1", "g"), ("B", 1, "n", "h2", "g")], schemas.SOURCES)
    targets = spark.createDataFrame([("T", 1, "lake", "ingest", "t", 10)], schemas.TARGETS)
    assert sorted(r.mapping for r in R.match_routes(sources, targets).collect()) == ["A->T", "B->T"]


def test_route_messages_and_write(spark, tmp_path):
    messages = spark.range(90).selectExpr(
        "CASE WHEN id % 3 = 0 THEN concat('h', id % 5) ELSE 'hot' END AS hub", "id AS sequence_number"
    )
    routes = spark.createDataFrame([("hot", "t_hot"), ("h1", "t1"), ("h2", "")], "hub string, table_name string")
    routed = R.route_messages(messages, routes, ["hub"])
    lost = R.unrouted_messages(messages, routes, ["hub"])
    assert routed.count() + lost.count() == 90
    R.write_routed(routed, str(tmp_path / "out"), ["table_name"])
    landed = spark.read.parquet(str(tmp_path / "out"))
    counts = {r.table_name: r["count"] for r in landed.groupBy("table_name").count().collect()}
    assert counts == {"t_hot": 60, "t1": 6, "events": 6}


def test_key_numbers(spark):
    df = spark.createDataFrame([("SOURCE_12",), ("SOURCE",)], "k string")
    assert [r[0] for r in df.select(R.key_of(df.k)).collect()] == [12, None]
