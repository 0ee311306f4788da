"""Metrics (M1-M26) as distributed aggregations.

Every metric takes a ``scored`` DataFrame, grouping keys (default
``model, task``) and column names, and returns ``metrics_long``:
``(*keys, metric, sub_metric, score)``. ``sub_metric`` is ``''`` for scalar
metrics. One-pass metrics also expose their aggregate expressions so an
evaluation suite can fuse many of them into a single ``groupBy().agg``.
"""

from .base import METRIC_COLUMNS, long_from_wide  # noqa: F401
