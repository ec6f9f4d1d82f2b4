"""Starting, driving and inspecting streaming queries; sinks and keyed merges."""

from tideline.streaming.runner import Trigger, run, start, state_store_provider
from tideline.streaming.sinks import (
    ChangelogWriter,
    JdbcWriter,
    RowFileWriter,
    TopicWriter,
    compact_closed,
    read_changelog,
    read_compacted,
    read_topic,
)
from tideline.streaming.merge import (
    MergeWriter,
    PartitionMergeWriter,
    hash_part,
    merge,
    merge_into,
    read_history,
    read_merged,
    read_partitions,
)
from tideline.streaming.delivery import DeliveryWriter, OutboxSender, read_outbox
from tideline.streaming.inspect import checkpoint_offsets, kafka_offsets, progress_frame
from tideline.streaming.late import LateSplitter, read_split
from tideline.streaming.recovery import AttemptLog, read_attempts, run_with_restarts
from tideline.streaming.state import open_windows, state_metadata, state_rows

__all__ = [
    "AttemptLog",
    "ChangelogWriter",
    "DeliveryWriter",
    "JdbcWriter",
    "LateSplitter",
    "MergeWriter",
    "OutboxSender",
    "PartitionMergeWriter",
    "RowFileWriter",
    "TopicWriter",
    "Trigger",
    "checkpoint_offsets",
    "compact_closed",
    "hash_part",
    "kafka_offsets",
    "merge",
    "merge_into",
    "open_windows",
    "progress_frame",
    "read_attempts",
    "read_changelog",
    "read_compacted",
    "read_history",
    "read_merged",
    "read_outbox",
    "read_partitions",
    "read_split",
    "read_topic",
    "run",
    "run_with_restarts",
    "start",
    "state_metadata",
    "state_rows",
    "state_store_provider",
]
