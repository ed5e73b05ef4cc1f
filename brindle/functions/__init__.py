from brindle.functions import numeric, text

__all__ = ["numeric", "text"]
