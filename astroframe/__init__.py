"""astroframe: catalogue analytics as composable Spark DataFrame operators.

Every public operator is ``f(df, ...params) -> DataFrame`` and stays lazy;
the few that need an exact scalar first (quantiles, model fits) run
distributed aggregates and only bring tiny results to the driver.
"""

__version__ = "0.1.0"
