"""Spark batch and streaming operators for the data work around language models."""

from lantern.session import build_session, durable, shared_dir, ship

__all__ = ["build_session", "durable", "shared_dir", "ship"]
