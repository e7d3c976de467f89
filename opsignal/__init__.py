"""Spark DataFrame operators for operational signals: alerts, tickets and log lines."""

from opsignal.config import Config, DEFAULT

__all__ = ["Config", "DEFAULT"]
