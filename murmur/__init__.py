"""murmur: social-post opinion analytics as Spark DataFrame programs.

Every operator is a pure ``DataFrame -> DataFrame`` function built from
Spark's own joins, aggregates, windows, ML stages and Structured Streaming.
Jobs in :mod:`murmur.plans.jobs` compose operators and do I/O at the edges.
"""

__version__ = "0.1.0"
