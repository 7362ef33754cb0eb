"""Kafka source. The connector jar is the cluster's business; credentials are arguments."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def kafka_options(
    servers: str,
    topic: str,
    user: str,
    password: str,
    starting_offsets: str = "earliest",
    max_offsets: int | None = None,
    login_module: str = "org.apache.kafka.common.security.plain.PlainLoginModule",
) -> dict[str, str]:
    """Reader options for one topic behind SASL over TLS."""

    def quoted(text: str) -> str:
        escaped = text.replace("\\", "\\\\").replace('"', '\\"')
        return f'"{escaped}"'

    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting_offsets,
        "kafka.security.protocol": "SASL_SSL",
        "kafka.sasl.mechanism": "PLAIN",
        "kafka.sasl.jaas.config": (
            f"{login_module} required username={quoted(user)} password={quoted(password)};"
        ),
    }
    if max_offsets:
        options["maxOffsetsPerTrigger"] = str(max_offsets)
    return options


def read_kafka_stream(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    """The raw message stream (binary ``value``); decode it with ``decode_json_value``."""
    return spark.readStream.format("kafka").options(**options).load()
