"""Gates on streams: the batch suite applied to every micro-batch."""
from .gate import gate_stream  # noqa: F401
