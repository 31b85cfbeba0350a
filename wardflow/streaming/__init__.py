from . import jobs, monitor

__all__ = ["jobs", "monitor"]
