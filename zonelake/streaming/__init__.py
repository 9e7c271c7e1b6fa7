"""Micro-batch entry points for the incremental warehouse load."""

from zonelake.streaming.incremental import idempotent_sink  # noqa: F401
