from tidemark.streaming.arrivals import land_arrivals, run_arrivals, run_flat_arrivals

__all__ = ["land_arrivals", "run_arrivals", "run_flat_arrivals"]
