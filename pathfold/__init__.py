"""pathfold - customer-journey paths on Spark DataFrames.

From a flat log of marketing hits: select one project's hits in a date
range, label each hit with its channel, mark target-goal hits as
conversions, order every client's hits in time, cut the history after each
conversion into paths and report paths per client, path counts and each
path's share of conversions.
"""
from .params import JobParams, date_to_epoch_ms

__all__ = ["JobParams", "date_to_epoch_ms"]
