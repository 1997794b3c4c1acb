"""Column expressions: channel labels, goal rules, conversion marks, dates."""
from .channel import channel_label, utm_source_channel
from .dates import epoch_ms_ntz, local_midnight_ms
from .goals import (conversion_mark, goal_null_to_transit, goal_target_or_transit, is_conversion,
                    tagged_touch, touch_map)

__all__ = ["channel_label", "utm_source_channel", "epoch_ms_ntz", "local_midnight_ms",
           "conversion_mark", "goal_null_to_transit", "goal_target_or_transit", "is_conversion",
           "tagged_touch", "touch_map"]
