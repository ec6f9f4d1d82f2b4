"""Sources: Kafka option builder and reader, file replay of Kafka-shaped records, table scan."""

from tideline.sources.kafka import credentials_from_env, kafka_options, kafka_sink_options, read_kafka
from tideline.sources.replay import (
    ENVELOPE_DDL,
    BatchRule,
    StagedTopic,
    envelope_from_events,
    read_replay,
    stage_topic,
)
from tideline.sources.tables import table_scan, table_stream

__all__ = [
    "ENVELOPE_DDL",
    "BatchRule",
    "StagedTopic",
    "credentials_from_env",
    "envelope_from_events",
    "kafka_options",
    "kafka_sink_options",
    "read_kafka",
    "read_replay",
    "stage_topic",
    "table_scan",
    "table_stream",
]
