"""wardflow: clinical event analytics written as PySpark DataFrame jobs.

Every operator is a plain function from DataFrame to DataFrame (or Column to Column); nothing
here builds a session, so the same code runs on a laptop and on a cluster.
"""

__version__ = "0.1.0"
