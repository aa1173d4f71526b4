"""Structured Streaming jobs."""

from tallgrass.streaming.landing import LandingRun, incremental_landing, landed

__all__ = ["LandingRun", "incremental_landing", "landed"]
