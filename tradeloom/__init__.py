"""Trade-feed analytics on Spark: ingest, windowed VWAP, anomaly flags, quality gate and alert digests."""

from tradeloom.config import Config, build_session

__all__ = ["Config", "build_session"]
