from tidewatch.streaming.refresh import refresh_from_stream

__all__ = ["refresh_from_stream"]
