"""Keyed messages to a topic."""

from __future__ import annotations

from pyspark.sql import DataFrame

from postlake.sources import messages


def producer_options(servers: str, topic: str, security: dict[str, str] | None = None) -> dict[str, str]:
    return {
        "kafka.bootstrap.servers": servers,
        "topic": topic,
        "kafka.acks": "all",
        **{f"kafka.{name}": value for name, value in (security or {}).items()},
    }


def publish(posts: DataFrame, servers: str, topic: str, security: dict[str, str] | None = None) -> None:
    """Rows as JSON messages keyed by post, so that all versions of a post share a partition."""
    encoded = messages.encode(posts)
    encoded.write.format("kafka").options(**producer_options(servers, topic, security)).save()
