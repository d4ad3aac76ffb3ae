"""Spark-native analytics over forum archives and the ticker symbols they mention."""

from mentionlake.session import build_session, prepare

__all__ = ["build_session", "prepare"]
