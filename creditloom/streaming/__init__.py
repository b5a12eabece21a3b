"""The same row-local plans on a streaming DataFrame."""

from .scoring import decide_stream, prepare_stream

__all__ = ["decide_stream", "prepare_stream"]
