"""tideline: event-stream analytics on PySpark DataFrames and Structured Streaming.

Every transform is a plain ``DataFrame -> DataFrame`` function that runs unchanged
on batch and streaming frames:

- ``tideline.sources``: Kafka options and reader, file replay of the Kafka
  envelope, table scan;
- ``tideline.functions``: decode, JSON parse/encode, event time;
- ``tideline.operators``: counts, windows, distinct, de-duplication, validation,
  watermark;
- ``tideline.streaming``: start/run with triggers and output modes, per-batch
  sinks, the versioned table (merge, history), checkpoint and progress
  inspection;
- ``tideline.plans``: the query catalogue and its DuckDB oracle SQL.
"""

from tideline import functions, operators, sources, streaming
from tideline.session import pin_utc, scratch_path, shared_dir

__all__ = [
    "functions",
    "operators",
    "pin_utc",
    "scratch_path",
    "shared_dir",
    "sources",
    "streaming",
]
