from brindle.sources import readers, schemas, sinks

__all__ = ["readers", "schemas", "sinks"]
