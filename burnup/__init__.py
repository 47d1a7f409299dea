"""burnup: effort accounting and agile sprint analytics as Spark DataFrame operators.

Every operator is a function from DataFrames (and an explicit ``as_of`` time where
the logic needs "now") to a DataFrame. Nothing is collected to the driver except
bounded scalars (for example the holiday calendar as one array).
"""

from burnup.session import get_session, checkpoint_dir

__all__ = ["get_session", "checkpoint_dir"]
