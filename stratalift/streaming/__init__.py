from stratalift.streaming.arrivals import land_arrivals, read_arrivals

__all__ = ["land_arrivals", "read_arrivals"]
