"""Kafka source and sink options.

The Kafka connector jar is not bundled with PySpark; ``read_kafka`` needs
``spark-sql-kafka-0-10`` on the classpath. Option building is plain Python and
is unit tested; credentials come from the caller and are never logged.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

_PLAIN_LOGIN = "org.apache.kafka.common.security.plain.PlainLoginModule"


class _Options(dict):
    """Option map whose repr masks the JAAS line (it holds the password)."""

    def __repr__(self) -> str:  # pragma: no cover - cosmetic
        shown = {k: ("***" if "jaas" in k else v) for k, v in self.items()}
        return f"KafkaOptions({shown!r})"


def _security(username: str | None, password: str | None, login_module: str) -> dict[str, str]:
    if username is None and password is None:
        return {}
    if not username or not password:
        raise ValueError("both username and password are needed for SASL PLAIN")
    for part in (username, password):
        if '"' in part or "\n" in part:
            raise ValueError("credentials may not contain quotes or newlines")
    return {
        "kafka.security.protocol": "SASL_SSL",
        "kafka.sasl.mechanism": "PLAIN",
        "kafka.ssl.endpoint.identification.algorithm": "https",
        "kafka.sasl.jaas.config": (
            f'{login_module} required username="{username}" password="{password}";'
        ),
    }


def credentials_from_env(username_var: str, password_var: str) -> tuple[str, str]:
    """(username, password) from environment variables named by the caller.

    Raises if either is unset, so a missing secret fails at start-up rather than
    as an authentication error inside the stream.
    """
    import os

    missing = [v for v in (username_var, password_var) if not os.environ.get(v)]
    if missing:
        raise KeyError(f"environment variables not set: {', '.join(missing)}")
    return os.environ[username_var], os.environ[password_var]


def kafka_options(
    bootstrap_servers: str,
    topics: str | list[str],
    starting_offsets: str = "earliest",
    fail_on_data_loss: bool = False,
    username: str | None = None,
    password: str | None = None,
    login_module: str = _PLAIN_LOGIN,
    max_offsets_per_trigger: int | None = None,
    extra: Mapping[str, str] | None = None,
) -> dict[str, str]:
    """Options for ``readStream.format("kafka")``.

    Topic names are trimmed (a trailing space in a topic name is a classic
    mistake). ``starting_offsets`` is ``earliest``, ``latest`` or a JSON offset
    map. ``max_offsets_per_trigger`` bounds micro-batch size, which keeps batch
    duration and state-store commits predictable at high ingest rates.
    """
    if not bootstrap_servers:
        raise ValueError("bootstrap_servers is required")
    names = [topics] if isinstance(topics, str) else list(topics)
    names = [t.strip() for t in names if t and t.strip()]
    if not names:
        raise ValueError("at least one topic is required")
    if starting_offsets not in ("earliest", "latest") and not starting_offsets.startswith("{"):
        raise ValueError("starting_offsets must be earliest, latest or a JSON offset map")
    opts = _Options(
        {
            "kafka.bootstrap.servers": bootstrap_servers,
            "subscribe": ",".join(names),
            "startingOffsets": starting_offsets,
            "failOnDataLoss": str(bool(fail_on_data_loss)).lower(),
        }
    )
    opts.update(_security(username, password, login_module))
    if max_offsets_per_trigger is not None:
        opts["maxOffsetsPerTrigger"] = str(int(max_offsets_per_trigger))
    if extra:
        opts.update({k: str(v) for k, v in extra.items()})
    return opts


def kafka_sink_options(
    bootstrap_servers: str,
    topic: str,
    username: str | None = None,
    password: str | None = None,
    login_module: str = _PLAIN_LOGIN,
) -> dict[str, str]:
    """Options for ``writeStream.format("kafka")`` (records need ``key``/``value``)."""
    if not topic or not topic.strip():
        raise ValueError("topic is required")
    opts = _Options({"kafka.bootstrap.servers": bootstrap_servers, "topic": topic.strip()})
    opts.update(_security(username, password, login_module))
    return opts


def read_kafka(spark: SparkSession, options: Mapping[str, str]) -> DataFrame:
    """Streaming Kafka envelope: key, value (BINARY), topic, partition, offset, timestamp, timestampType."""
    return spark.readStream.format("kafka").options(**options).load()
