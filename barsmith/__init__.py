"""barsmith — time-series feature, backtest and drift engine on Spark.

Every operator is a function ``f(df, ...) -> DataFrame`` built from
DataFrame / SQL expressions so Catalyst plans the whole pipeline.
"""

from barsmith.session import get_session, checkpoint_dir, prepare

__all__ = ["get_session", "checkpoint_dir", "prepare"]
