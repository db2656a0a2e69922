"""Public-transport feed analytics as Spark DataFrame plans.

Every table carries the feed columns (``explotation``, ``contract``, ``version``), so one job
handles all feeds at once.  The public surface is functions on Columns and DataFrames.
"""

from headway.session import tune

__all__ = ["tune"]
