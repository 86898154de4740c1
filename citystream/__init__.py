"""citystream: city telemetry analytics expressed as Spark DataFrame plans.

Every operator is a ``DataFrame -> DataFrame`` function built from Spark SQL
expressions, so Catalyst can prune, push down and plan it.  Stateless and
windowed operators run unchanged on batch and streaming frames; the two
stateful detectors (gridlock, bus bunching) have a batch form built from
joins, aggregates and windows, and a streaming form built on keyed state.
"""

from citystream.session import get_session, checkpoint_root, scratch_path

__all__ = ["get_session", "checkpoint_root", "scratch_path"]
