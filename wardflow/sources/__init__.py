from . import generators, messages, readers

__all__ = ["generators", "messages", "readers"]
