"""DataFrame operators: filters, client sets, ordered histories, paths."""
from . import clients, filters
from .channels import ChannelNumbers, channel_numbers
from .segments import segment_filter, segments
from .sequence import History, Overview, history, numbered, overview, sequence

__all__ = ["clients", "filters", "ChannelNumbers", "channel_numbers", "segment_filter", "segments", "History", "Overview", "history", "overview", "numbered", "sequence"]
