from brindle.streaming import arrivals

__all__ = ["arrivals"]
