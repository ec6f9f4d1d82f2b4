"""Column-level functions: byte decoding, JSON parsing and encoding, event time."""

from tideline.functions.codec import (
    TRANSACTION_DDL,
    decode,
    parse_json,
    to_kv_json,
)
from tideline.functions.time import to_event_time

__all__ = ["TRANSACTION_DDL", "decode", "parse_json", "to_kv_json", "to_event_time"]
