"""Named queries over the test tables, each with the SQL that must give the same rows."""

from tidemark.plans import batches, ingestion, operations, resume, streams

CATALOG = {**ingestion.QUERIES, **resume.QUERIES, **batches.QUERIES, **operations.QUERIES, **streams.QUERIES}
