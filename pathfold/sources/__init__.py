"""Sources: parquet / CSV hit logs, the JSON job config, hits from ``events``."""
from .bucketed import read_bucketed_hits, write_bucketed_hits
from .config import read_config
from .csv import read_csv_hits
from .events import events_to_hits, hits_from_events
from .hits import read_hits, to_hit_schema

__all__ = ["read_bucketed_hits", "write_bucketed_hits", "read_hits", "to_hit_schema", "read_csv_hits", "read_config",
           "events_to_hits", "hits_from_events"]
