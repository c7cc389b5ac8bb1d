"""Incremental media-metrics lakehouse as Spark DataFrame plans."""
