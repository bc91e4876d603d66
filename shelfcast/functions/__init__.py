from .expressions import fill_constant, holds, null_flag, ratio, truncated, typed_null
from .metrics import regression_metrics
from .split import hash_bucket, split_label

__all__ = [
    "fill_constant",
    "hash_bucket",
    "holds",
    "null_flag",
    "ratio",
    "regression_metrics",
    "split_label",
    "truncated",
    "typed_null",
]
