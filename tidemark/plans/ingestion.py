"""Envelope projection, text functions and routing."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from tidemark.functions import envelope as E
from tidemark.functions import text as X
from tidemark.operators import routing as R
from tidemark.plans import inputs as I
from tidemark.session import shared_folder

INGESTED = datetime(2024, 2, 1)


def ingest_envelope(spark, sf_dir):
    """JSON properties pass through, system properties are a header map."""
    system = F.create_map(F.lit("partition"), F.encode("partition_id", "UTF-8"))
    raw = I.messages(spark, sf_dir).withColumn("system_properties", system)
    return E.to_target_rows(E.valid_messages(raw), F.lit(INGESTED))


INGEST_ENVELOPE = f"""WITH {I.MESSAGES}
SELECT body AS event_body, partition_id, sequence_number, enqueued_time, properties,
  concat('{{"partition":"', partition_id, '"}}') AS system_properties,
  TIMESTAMP '2024-02-01 00:00:00' AS ingestion_timestamp FROM valid"""


def ingest_documents(spark, sf_dir):
    """Binary bodies of any length and binary header maps, some of them empty."""
    headers = F.map_from_arrays(
        F.array(F.lit("lang"), F.lit("source")), F.array(F.encode("lang", "UTF-8"), F.encode("source", "UTF-8"))
    )
    empty = F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<binary>"))
    raw = I.table(spark, sf_dir, "documents").select(
        F.encode("text", "UTF-8").alias("body"),
        (F.col("doc_id") % 8).cast("string").alias("partition_id"),
        F.col("doc_id").alias("sequence_number"),
        F.when(F.col("doc_id") % 10 == 0, empty).otherwise(headers).alias("properties"),
    )
    return E.to_target_rows(raw, F.lit(INGESTED))


INGEST_DOCUMENTS = """
SELECT text AS event_body, CAST(doc_id % 8 AS VARCHAR) AS partition_id, doc_id AS sequence_number,
  CAST(NULL AS TIMESTAMP) AS enqueued_time,
  CASE WHEN doc_id % 10 <> 0 THEN concat('{"lang":"', lang, '","source":"', source, '"}') END AS properties,
  CAST(NULL AS VARCHAR) AS system_properties, TIMESTAMP '2024-02-01 00:00:00' AS ingestion_timestamp
FROM documents"""


def nested_bytes(spark, sf_dir):
    """Bytes as keys, values, list items and struct fields become text."""
    turns = I.table(spark, sf_dir, "conversations")
    role, turn = F.encode("role", "UTF-8"), F.col("turn")
    value = F.create_map(role, F.array(F.struct(F.encode("text", "UTF-8").alias("text"), turn.alias("turn"))))
    nested = turns.select("conv_id", "turn", value.alias("value"))
    return nested.select("conv_id", "turn", E.as_json(F.col("value"), nested.schema["value"].dataType).alias("json"))


NESTED_BYTES = """
SELECT conv_id, turn,
  CAST(concat('{"', role, '":', to_json([{'text': text, 'turn': turn}]), '}') AS VARCHAR) AS json
FROM conversations"""


def concat_streams(spark, sf_dir):
    """Four tables as streams of one batch, whole texts included."""

    def stream(name, key, body):
        return I.table(spark, sf_dir, name).select(
            F.col(body).alias("event_body"),
            (F.col(key) % 4).cast("string").alias("partition_id"),
            F.col(key).alias("sequence_number"),
        )

    return R.concat_streams(
        {
            "documents": stream("documents", "doc_id", "text"),
            "pages": stream("pages", "page_id", "html"),
            "conversations": stream("conversations", "conv_id", "text"),
            "events": stream("events", "event_id", "event_type"),
        }
    )


CONCAT_STREAMS = " UNION ALL ".join(
    f"SELECT {body} AS event_body, CAST({key} % 4 AS VARCHAR) AS partition_id, {key} AS sequence_number, "
    f"'{name}' AS eventhub FROM {name}"
    for name, key, body in [
        ("documents", "doc_id", "text"),
        ("pages", "page_id", "html"),
        ("conversations", "conv_id", "text"),
        ("events", "event_id", "event_type"),
    ]
)


def enqueued_text(spark, sf_dir):
    """P5: ISO text with an offset is brought to UTC; text without one is UTC already."""
    stamp = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    zone = F.element_at(F.array(F.lit("+02:00"), F.lit("Z"), F.lit(""), F.lit("-05:30")), (F.col("event_id") % 4 + 1).cast("int"))
    texts = I.table(spark, sf_dir, "events").select("event_id", F.concat(stamp, zone).alias("text"))
    return texts.select("event_id", E.utc_timestamp(F.col("text"), texts.schema["text"].dataType).alias("enqueued_time"))


ENQUEUED_TEXT = """
SELECT event_id, ts - to_minutes(([120, 0, 0, -330])[event_id % 4 + 1]) AS enqueued_time FROM events"""


def properties_access(spark, sf_dir):
    """Typed value out of a JSON column."""
    events = I.table(spark, sf_dir, "events")
    return events.select("event_id", E.metadata_field(F.col("props"), "k", "bigint").alias("k"))


PROPERTIES_ACCESS = "SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events"


def offset_fallback(spark, sf_dir):
    """P7"""
    valid = I.valid_messages(spark, sf_dir)
    return valid.select(
        "partition_id", "sequence_number", E.parse_offset(F.col("offset"), F.col("sequence_number")).alias("waterlevel")
    )


OFFSET_FALLBACK = f"""WITH {I.MESSAGES}
SELECT partition_id, sequence_number, coalesce(TRY_CAST("offset" AS BIGINT), sequence_number) AS waterlevel FROM valid"""


def mask_secret(spark, sf_dir):
    """Numbers of any length as secrets, and names as the token in a connection text."""
    customers = I.table(spark, sf_dir, "customer")
    return customers.select(
        "c_custkey",
        X.mask_secret((F.col("c_custkey") * 13).cast("string")).alias("masked"),
        X.mask_connection(F.concat(F.lit("db:lake?token="), "c_name")).alias("connection"),
    )


MASK_SECRET = """
SELECT c_custkey, CASE WHEN length(s) > 4 THEN concat('***', right(s, 4)) ELSE '***' END AS masked,
  'db:lake?token=***' AS connection
FROM (SELECT c_custkey, CAST(c_custkey * 13 AS VARCHAR) AS s FROM customer)"""


def routes_matched(spark, sf_dir):
    """J1, J8, P12"""
    return R.match_routes(I.sources(spark, sf_dir), I.targets(spark, sf_dir))


ROUTES_MATCHED = f"WITH {I.ROUTES} SELECT * FROM routes"


def routes_incomplete(spark, sf_dir):
    """Sources whose configuration is an error."""
    return R.incomplete_sources(I.sources(spark, sf_dir)).select("source_key", "name")


ROUTES_INCOMPLETE = f"WITH {I.ROUTES} SELECT source_key, name FROM sources WHERE consumer_group IS NULL"


def routes_unmatched(spark, sf_dir):
    """J2, U1"""
    return R.unmatched(I.sources(spark, sf_dir), I.targets(spark, sf_dir))


ROUTES_UNMATCHED = f"""WITH {I.ROUTES}
SELECT 'source' AS side, source_key AS key FROM sources WHERE route_no NOT IN (SELECT route_no FROM targets)
UNION ALL
SELECT 'target' AS side, target_key AS key FROM targets WHERE route_no NOT IN (SELECT route_no FROM sources)"""


def routes_invalid(spark, sf_dir):
    """One mapping per customer, some of which point nowhere."""
    mappings = I.table(spark, sf_dir, "customer").selectExpr(
        "concat('SOURCE_', c_nationkey + 5) AS source_key", "concat('TARGET_', c_custkey % 150) AS target_key"
    )
    return R.invalid_mappings(mappings, I.sources(spark, sf_dir), I.targets(spark, sf_dir))


ROUTES_INVALID = f"""WITH {I.ROUTES},
mappings AS (SELECT concat('SOURCE_', c_nationkey + 5) AS source_key, concat('TARGET_', c_custkey % 150) AS target_key
  FROM customer)
SELECT source_key, target_key, 'source' AS missing FROM mappings WHERE source_key NOT IN (SELECT source_key FROM sources)
UNION ALL
SELECT source_key, target_key, 'target' AS missing FROM mappings WHERE target_key NOT IN (SELECT target_key FROM all_targets)"""


def config_counts(spark, sf_dir):
    """A11"""
    return R.configuration_counts(I.sources(spark, sf_dir), I.targets(spark, sf_dir))


CONFIG_COUNTS = f"""WITH {I.ROUTES}
SELECT (SELECT count(*) FROM sources) AS sources_count, (SELECT count(*) FROM targets) AS targets_count,
  (SELECT count(*) FROM routes) AS mappings_count"""


def _routes(spark, sf_dir):
    routes = R.match_routes(I.sources(spark, sf_dir), I.targets(spark, sf_dir))
    return routes.withColumnRenamed("name", "eventhub")


def channel_names(spark, sf_dir):
    """Every message with its target and channel."""
    routed = R.route_messages(I.valid_messages(spark, sf_dir), _routes(spark, sf_dir), ["eventhub"])
    return routed.select(
        "sequence_number",
        X.channel_name(F.col("eventhub"), F.col("partition_id"), "prod", "west").alias("channel"),
        X.channel_label(F.col("namespace"), F.col("eventhub")).alias("label"),
        "mapping",
        "table_name",
    )


CHANNEL_NAMES = f"""WITH {I.MESSAGES}, {I.ROUTES}
SELECT sequence_number, concat(eventhub, '-prod-west-', partition_id) AS channel, concat(namespace, '/', eventhub) AS label,
  mapping, table_name FROM valid JOIN routes ON eventhub = name"""


def routed_tables(spark, sf_dir):
    """Messages written to one folder per target and read back."""
    routed = R.route_messages(I.valid_messages(spark, sf_dir), _routes(spark, sf_dir), ["eventhub"])
    folder = shared_folder(spark, "routed")
    rows = routed.select("table_name", "eventhub", "partition_id", "sequence_number", "body")
    R.write_routed(rows, folder, ["table_name"])
    return spark.read.schema(rows.schema).parquet(folder)


ROUTED_TABLES = f"""WITH {I.MESSAGES}, {I.ROUTES}
SELECT table_name, eventhub, partition_id, sequence_number, body FROM valid JOIN routes ON eventhub = name"""


def unrouted_messages(spark, sf_dir):
    """Messages of streams without a route."""
    lost = R.unrouted_messages(I.valid_messages(spark, sf_dir), _routes(spark, sf_dir), ["eventhub"])
    return lost.select("eventhub", "partition_id", "sequence_number")


UNROUTED_MESSAGES = f"""WITH {I.MESSAGES}, {I.ROUTES}
SELECT eventhub, partition_id, sequence_number FROM valid WHERE eventhub NOT IN (SELECT name FROM routes)"""


QUERIES = {
    "ingest_envelope": (ingest_envelope, INGEST_ENVELOPE),
    "ingest_documents": (ingest_documents, INGEST_DOCUMENTS),
    "nested_bytes": (nested_bytes, NESTED_BYTES),
    "concat_streams": (concat_streams, CONCAT_STREAMS),
    "enqueued_text": (enqueued_text, ENQUEUED_TEXT),
    "properties_access": (properties_access, PROPERTIES_ACCESS),
    "offset_fallback": (offset_fallback, OFFSET_FALLBACK),
    "mask_secret": (mask_secret, MASK_SECRET),
    "routes_matched": (routes_matched, ROUTES_MATCHED),
    "routes_incomplete": (routes_incomplete, ROUTES_INCOMPLETE),
    "routes_unmatched": (routes_unmatched, ROUTES_UNMATCHED),
    "routes_invalid": (routes_invalid, ROUTES_INVALID),
    "config_counts": (config_counts, CONFIG_COUNTS),
    "channel_names": (channel_names, CHANNEL_NAMES),
    "routed_tables": (routed_tables, ROUTED_TABLES),
    "unrouted_messages": (unrouted_messages, UNROUTED_MESSAGES),
}
