"""The continuous cleaner."""

from casemill.streaming.clean_stream import run_clean_stream, write_batch

__all__ = ["run_clean_stream", "write_batch"]
