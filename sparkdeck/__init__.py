"""sparkdeck — table analytics and applied machine learning on Spark DataFrames.

Layout: ``sources`` (readers, writers, catalog), ``operators`` (verbs Spark lacks as
one call: skew-safe ordered scans, splits, statistics, feature steps), ``functions``
(column expressions), ``ml`` (model fitting, evaluation, search), ``plans`` (the
query catalogue and its DuckDB oracle), ``streaming`` (notes; the reference has no
stream operators).
"""

from .session import ensure_checkpoint_dir, get_session

__all__ = ["ensure_checkpoint_dir", "get_session"]
__version__ = "0.1.0"
