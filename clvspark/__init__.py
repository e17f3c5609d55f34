"""Customer value analytics on Spark DataFrames.

Functions take DataFrames and return DataFrames. None of them creates a
session, changes session settings, or collects customer rows to the driver.
"""

__version__ = "0.1.0"
