from .boosting import BoostParams, fit_boosted
from .features import assembler, category_codes, category_indexer, feature_frame, feature_inputs
from .runs import RunLog
from .scoring import mean_by_store, predict_store_mean, scored_rows, scoring_table
from .training import GBTParams, fit, load_model, split_rows
from .trees import Node, TreeModel

__all__ = [
    "BoostParams",
    "GBTParams",
    "Node",
    "RunLog",
    "TreeModel",
    "assembler",
    "category_codes",
    "category_indexer",
    "feature_frame",
    "feature_inputs",
    "fit",
    "fit_boosted",
    "load_model",
    "mean_by_store",
    "predict_store_mean",
    "scored_rows",
    "scoring_table",
    "split_rows",
]
