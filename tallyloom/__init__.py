"""Batch dossiers, time axes and map layers as Spark DataFrame operations."""
