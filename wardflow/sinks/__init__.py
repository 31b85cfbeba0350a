from . import streams, tables

__all__ = ["streams", "tables"]
