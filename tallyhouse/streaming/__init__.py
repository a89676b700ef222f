from tallyhouse.streaming.highwater import Extract, resolve_window
from tallyhouse.streaming.marks import ExtractLog

__all__ = ["Extract", "ExtractLog", "resolve_window"]
