"""Layered table pipelines, described by table specs and run as Spark jobs."""

__version__ = "0.1.0"
