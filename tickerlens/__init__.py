"""tickerlens: ticker-mention, sentiment and price-bar analytics on Spark.

Every public function takes DataFrames (and plain parameters) and returns a
DataFrame; nothing holds a global session.
"""

from tickerlens.functions.timefn import GRAINS, grain_columns, normalize_grain  # noqa: F401

__version__ = "0.1.0"
