"""Queries over the control log."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.functions import envelope as E
from tidemark.operators import batching as B
from tidemark.operators import checkpoints as C
from tidemark.plans import inputs as I
from tidemark.session import shared_folder
from tidemark.sources import tables

KEY = C.ControlKey("ns0", "nation_0", "lake", "ingest", "nation_0")
IS_KEY = """eventhub_namespace = 'ns0' AND eventhub = 'nation_0' AND target_db = 'lake' AND target_schema = 'ingest'
  AND target_table = 'nation_0'"""
BY = [*schemas.CONTROL_KEY, "partition_id"]
BY_SQL = ", ".join(BY)


def resume_max(spark, sf_dir):
    """F2, A1, S3: where one mapping resumes, as a stream client wants it."""
    points = C.resume_points(C.entries_of(I.control_log(spark, sf_dir), KEY))
    return C.checkpoint_listing(points, F.lit(KEY.namespace), F.lit(KEY.hub), F.lit("$Default"))


RESUME_MAX = f"""WITH {I.CONTROL}
SELECT 'ns0' AS fully_qualified_namespace, 'nation_0' AS eventhub_name, '$Default' AS consumer_group, partition_id,
  CAST(max(waterlevel) AS VARCHAR) AS "offset", max(waterlevel) AS sequence_number
FROM control WHERE {IS_KEY} AND partition_id IS NOT NULL GROUP BY partition_id"""


def resume_all(spark, sf_dir):
    """A1 for all mappings at once."""
    return C.resume_points(I.control_log(spark, sf_dir), BY)


RESUME_ALL = f"""WITH {I.CONTROL}
SELECT {BY_SQL}, max(waterlevel) AS waterlevel FROM control WHERE partition_id IS NOT NULL GROUP BY ALL"""


def resume_group(spark, sf_dir):
    """A1 of the rows one consumer group wrote, read from the metadata."""
    return C.resume_points(C.entries_of(I.control_log(spark, sf_dir), KEY, "group1"))


RESUME_GROUP = f"""WITH {I.CONTROL}
SELECT partition_id, max(waterlevel) AS waterlevel FROM control
WHERE {IS_KEY} AND partition_id IS NOT NULL
  AND CASE WHEN json_valid(metadata) THEN json_extract_string(metadata, '$.consumer_group') END = 'group1'
GROUP BY partition_id"""


def resume_latest(spark, sf_dir):
    """W1"""
    return C.latest_points(I.control_log(spark, sf_dir), BY)


LATEST = f"""SELECT {BY_SQL}, ts_inserted, waterlevel FROM (
  SELECT *, row_number() OVER (PARTITION BY {BY_SQL} ORDER BY ts_inserted DESC, waterlevel DESC) AS row_num
  FROM control WHERE partition_id IS NOT NULL) WHERE row_num = 1"""
RESUME_LATEST = f"WITH {I.CONTROL} {LATEST}"


def resume_disagreement(spark, sf_dir):
    """A1 against W1"""
    return C.resume_disagreements(I.control_log(spark, sf_dir), BY)


RESUME_DISAGREEMENT = f"""WITH {I.CONTROL}, latest AS ({LATEST}),
highest AS (SELECT {BY_SQL}, max(waterlevel) AS highest_waterlevel FROM control
  WHERE partition_id IS NOT NULL GROUP BY ALL)
SELECT {BY_SQL}, highest_waterlevel, waterlevel AS latest_waterlevel
FROM highest JOIN latest USING ({BY_SQL}) WHERE highest_waterlevel <> waterlevel"""


def latest_status(spark, sf_dir):
    """W2"""
    return C.latest_status(I.control_log(spark, sf_dir), KEY)


LATEST_STATUS = f"""WITH {I.CONTROL}
SELECT ts_inserted, waterlevel FROM control WHERE {IS_KEY} ORDER BY ts_inserted DESC, waterlevel DESC LIMIT 1"""


def checkpoint_listing(spark, sf_dir):
    """W5"""
    return C.ordered_listing(I.control_log(spark, sf_dir))


CHECKPOINT_LISTING = f"WITH {I.CONTROL} SELECT partition_id, waterlevel FROM control ORDER BY partition_id, waterlevel"


def _unseen(spark, sf_dir, start_position):
    valid = I.valid_messages(spark, sf_dir)
    on = ["eventhub_namespace", "eventhub", "partition_id"]
    points = C.resume_points(I.control_log(spark, sf_dir), on)
    position = E.parse_offset(F.col("offset"), F.col("sequence_number"))
    return C.unseen_messages(valid, points, on, position, start_position).select(*on, "sequence_number", "offset")


def resume_filter(spark, sf_dir):
    """Streams without a checkpoint from their beginning."""
    return _unseen(spark, sf_dir, "earliest")


def resume_filter_latest(spark, sf_dir):
    """Streams without a checkpoint from their end."""
    return _unseen(spark, sf_dir, "latest")


UNSEEN = f"""WITH {I.CONTROL},
points AS (SELECT eventhub_namespace, eventhub, partition_id, max(waterlevel) AS resume FROM control
  WHERE partition_id IS NOT NULL GROUP BY ALL)
SELECT eventhub_namespace, eventhub, partition_id, sequence_number, "offset"
FROM valid LEFT JOIN points USING (eventhub_namespace, eventhub, partition_id)
WHERE coalesce(coalesce(TRY_CAST("offset" AS BIGINT), sequence_number) > resume, """
RESUME_FILTER = UNSEEN + "true)"
RESUME_FILTER_LATEST = UNSEEN + "false)"


def start_positions(spark, sf_dir):
    """Every partition that has messages, resumed or at the end of its stream."""
    on = ["eventhub", "partition_id"]
    partitions = I.messages(spark, sf_dir).select(*on).distinct()
    return C.start_positions(partitions, C.resume_points(I.control_log(spark, sf_dir), on), on)


START_POSITIONS = f"""WITH {I.CONTROL},
points AS (SELECT eventhub, partition_id, max(waterlevel) AS waterlevel FROM control
  WHERE partition_id IS NOT NULL GROUP BY ALL)
SELECT eventhub, partition_id, coalesce(CAST(waterlevel AS VARCHAR), '@latest') AS starts_at, waterlevel IS NOT NULL AS resumed
FROM (SELECT DISTINCT eventhub, partition_id FROM messages) LEFT JOIN points USING (eventhub, partition_id)"""


def checkpoint_log(spark, sf_dir):
    """Control rows of every batch, with metadata read back."""
    reached = B.batch_waterlevels(I.batched(spark, sf_dir), ["eventhub_namespace", "eventhub", "batch_no", "partition_id"])
    described = C.with_checkpoint_metadata(reached, F.col("eventhub_namespace"), F.col("eventhub"), F.lit("$Default"))
    keyed = described.withColumns(
        {"target_db": F.lit("lake"), "target_schema": F.lit("ingest"), "target_table": F.col("eventhub")}
    )
    rows = C.typed_metadata(C.required_columns(C.control_rows(keyed, ts_inserted=F.lit("2024-02-01").cast("timestamp_ntz"))))
    return rows.withColumns(
        {
            "offset_string": E.metadata_field(F.col("metadata"), "offset_string"),
            "consumer_group": E.metadata_field(F.col("metadata"), "consumer_group"),
        }
    ).drop("metadata")


CHECKPOINT_LOG = f"""WITH {I.BATCHED}
SELECT TIMESTAMP '2024-02-01 00:00:00' AS ts_inserted, eventhub_namespace, eventhub, 'lake' AS target_db,
  'ingest' AS target_schema, eventhub AS target_table, partition_id,
  coalesce(TRY_CAST("offset" AS BIGINT), sequence_number) AS waterlevel, sequence_number, "offset" AS offset_string,
  '$Default' AS consumer_group
FROM (SELECT *, row_number() OVER (PARTITION BY eventhub, batch_no, partition_id ORDER BY sequence_number DESC, arrival) AS r
  FROM batched) WHERE r = 1"""


def partition_metadata(spark, sf_dir):
    """Metadata is given for some partitions only."""
    control = I.control_log(spark, sf_dir)
    on = ["eventhub", "partition_id"]
    counts = I.valid_messages(spark, sf_dir).groupBy(*on).agg(F.count("*").alias("messages")).filter("messages % 2 = 0")
    metadata = counts.select(*on, F.to_json(F.struct("messages")).alias("metadata"))
    return C.with_partition_metadata(C.resume_points(control, on), metadata, on)


PARTITION_METADATA = f"""WITH {I.CONTROL},
counts AS (SELECT eventhub, partition_id, count(*) AS messages FROM valid GROUP BY ALL)
SELECT eventhub, partition_id, waterlevel,
  CASE WHEN messages % 2 = 0 THEN concat('{{"messages":', messages, '}}') END AS metadata
FROM (SELECT eventhub, partition_id, max(waterlevel) AS waterlevel FROM control WHERE partition_id IS NOT NULL GROUP BY ALL)
  LEFT JOIN counts USING (eventhub, partition_id)"""


def metadata_sequence(spark, sf_dir):
    """Sequence numbers out of metadata that may be absent or malformed."""
    return C.typed_metadata(I.control_log(spark, sf_dir)).select("eventhub", "waterlevel", "sequence_number")


METADATA_SEQUENCE = f"""WITH {I.CONTROL}
SELECT eventhub, waterlevel,
  CAST(CASE WHEN json_valid(metadata) THEN json_extract_string(metadata, '$.sequence_number') END AS BIGINT)
    AS sequence_number FROM control"""


def legacy_status(spark, sf_dir):
    """Text waterlevels, partition "0" where none is named."""
    statuses = I.control_log(spark, sf_dir).withColumn("waterlevel", F.concat(F.lit(" "), "waterlevel", F.lit(" ")))
    return C.legacy_status_rows(statuses, F.lit("2024-02-01").cast("timestamp_ntz"))


LEGACY_STATUS = f"""WITH {I.CONTROL}
SELECT * REPLACE (TIMESTAMP '2024-02-01 00:00:00' AS ts_inserted, coalesce(partition_id, '0') AS partition_id) FROM control"""


def _table_place(spark, label):
    """A new folder, and a database name that goes with it."""
    folder = shared_folder(spark, label)
    return folder, f"tidemark_{folder.rsplit('-', 1)[-1]}"


def target_table(spark, sf_dir):
    """Create the target table of a mapping and append its rows."""
    folder, database = _table_place(spark, "target-table")
    table = tables.create_target_table(spark, database, "ingest", "events", folder)
    tables.append_target(table, E.to_target_rows(I.valid_messages(spark, sf_dir), F.lit("2024-02-01").cast("timestamp_ntz")))
    return spark.table(table)


TARGET_TABLE = f"""WITH {I.MESSAGES}
SELECT body AS event_body, partition_id, sequence_number, enqueued_time, properties,
  CAST(NULL AS VARCHAR) AS system_properties, TIMESTAMP '2024-02-01 00:00:00' AS ingestion_timestamp FROM valid"""


def status_table(spark, sf_dir):
    """Rows without a partition are accepted, and an absent insert time is filled in."""
    folder, database = _table_place(spark, "status-table")
    table = tables.create_status_table(spark, database, "control", location=folder)
    untimed = F.when(F.col("waterlevel") % 3 > 0, F.col("ts_inserted"))
    tables.append_status(table, I.control_log(spark, sf_dir).withColumn("ts_inserted", untimed))
    filled = (F.col("waterlevel") % 3 == 0) & F.col("ts_inserted").isNotNull()
    return spark.table(table).select("eventhub", "partition_id", "waterlevel", filled.alias("filled"), "metadata")


STATUS_TABLE = f"""WITH {I.CONTROL}
SELECT eventhub, partition_id, waterlevel, waterlevel % 3 = 0 AS filled, metadata FROM control"""


def control_table(spark, sf_dir):
    """Fill a strict control table, list it, purge it, count what is left."""
    folder, database = _table_place(spark, "control-table")
    table = tables.create_control_table(spark, database, "control", "waterlevels", folder)
    tables.append_control(table, I.control_log(spark, sf_dir).filter("partition_id IS NOT NULL"))
    counted = C.purge_summary(tables.list_control(spark, table)).withColumn("step", F.lit("before"))
    before = spark.createDataFrame(counted.collect(), counted.schema)
    return before.unionByName(tables.purge_control(spark, table).withColumn("step", F.lit("after")))


CONTROL_TABLE = f"""WITH {I.CONTROL}
SELECT 'before' AS step, count(*) AS checkpoint_count FROM control WHERE partition_id IS NOT NULL
UNION ALL SELECT 'after' AS step, CAST(0 AS BIGINT) AS checkpoint_count"""


QUERIES = {
    "resume_max": (resume_max, RESUME_MAX),
    "resume_all": (resume_all, RESUME_ALL),
    "resume_group": (resume_group, RESUME_GROUP),
    "resume_latest": (resume_latest, RESUME_LATEST),
    "resume_disagreement": (resume_disagreement, RESUME_DISAGREEMENT),
    "latest_status": (latest_status, LATEST_STATUS),
    "checkpoint_listing": (checkpoint_listing, CHECKPOINT_LISTING),
    "resume_filter": (resume_filter, RESUME_FILTER),
    "resume_filter_latest": (resume_filter_latest, RESUME_FILTER_LATEST),
    "start_positions": (start_positions, START_POSITIONS),
    "checkpoint_log": (checkpoint_log, CHECKPOINT_LOG),
    "partition_metadata": (partition_metadata, PARTITION_METADATA),
    "metadata_sequence": (metadata_sequence, METADATA_SEQUENCE),
    "legacy_status": (legacy_status, LEGACY_STATUS),
    "target_table": (target_table, TARGET_TABLE),
    "status_table": (status_table, STATUS_TABLE),
    "control_table": (control_table, CONTROL_TABLE),
}
