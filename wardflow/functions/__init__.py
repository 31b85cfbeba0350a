from . import calendar, clinical, text

__all__ = ["calendar", "clinical", "text"]
