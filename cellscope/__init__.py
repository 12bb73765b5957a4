"""cellscope: network-quality analytics on Spark DataFrames.

Layers: sources (fixture view, JSON lake, CDC decode) -> operators (staging, curated,
serving, KPI, quality) -> plans (pipeline, publication) and streaming (landing, loading).
"""

from cellscope.session import get_spark, checkpoint_dir

__all__ = ["get_spark", "checkpoint_dir"]
