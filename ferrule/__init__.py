"""ferrule — a Spark-native ingest-to-dashboard revenue engine.

Raw client uploads and a partner performance feed are cleaned, joined,
aggregated and split into processed rows and a quarantine; fact tables are
refreshed idempotently; upload events are gated and de-duplicated with
Structured Streaming; dashboard metrics come back as DataFrames.

Everything is expressed with the DataFrame / SQL API so Catalyst can push
filters to the scan, prune columns and pick join strategies.  No Python UDFs.
"""

from ferrule.session import get_session, scratch_path

__all__ = ["get_session", "scratch_path"]
