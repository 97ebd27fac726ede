"""Spark-native tables and operators for reanalysing public proteomics projects."""

from massloom.session import build_session, checkpoint, scratch_dir

__all__ = ["build_session", "checkpoint", "scratch_dir"]
