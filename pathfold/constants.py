"""Fixed values of the hit-log model.

These must equal the values used by existing attribution jobs so that
reports built here line up with theirs, hence they are stated once, here.
"""

# --- fixed values -----------------------------------------------------------
# goal id meaning "this hit was not a conversion"
TRANSIT_ACTION = -1
# separator between touches in a path and between timestamps in a timeline
PATH_SEPARATOR = "=>"
# glue between a channel and its conversion marker in tagged touches
GLUE = "::_"
CONVERSION_MARK = "get@conv"
NO_CONVERSION_MARK = "get@no_conv"
# older (CSV-era) glue and markers
OLD_GLUE = "_"
OLD_CONVERSION_MARK = "1"
OLD_NO_CONVERSION_MARK = "0"
# channel label of the seizmik platform
SEIZMIK_CHANNEL = "seizmik_channel"
# text a missing channel part renders as
NULL_TEXT = "null"
# interaction types that name an adriver / dcm touch
INTERACTION_TYPES = ("view", "click")
# default zone in which report dates are read (midnight local time)
DEFAULT_ZONE = "Europe/Moscow"
# date shape accepted by the older jobs: the first match inside the argument
LOOSE_DATE_PATTERN = r"[12]\d{3}-(0[1-9]|1[0-2])-(0[1-9]|[12]\d|3[01])"
# names of the job options, all required
REQUIRED_OPTIONS = ("projectID", "date_start", "date_tHOLD", "date_finish", "target_numbers",
                    "product_name", "source_platform", "achieve_mode", "flat_path",
                    "output_path", "output_pathD")
# ---------------------------------------------------------------------------

# Hit-log schema: (column, Spark SQL type).  Readers cast to it with try_cast.
HIT_COLUMNS = (
    ("ProjectID", "bigint"),
    ("ClientID", "string"),
    ("HitTimeStamp", "bigint"),
    ("ga_sourcemedium", "string"),
    ("utm_source", "string"),
    ("utm_medium", "string"),
    ("utm_campaign", "string"),
    ("interaction_type", "string"),
    ("dcm_placement_id", "string"),
    ("profile", "string"),
    ("ga_location", "string"),
    ("goal", "bigint"),
    ("src", "string"),
)

# Columns no hit log can do without.
KEY_COLUMNS = ("ProjectID", "ClientID", "HitTimeStamp", "goal", "src")

# Older hit logs name two columns differently.
LEGACY_COLUMN_NAMES = {"adr_typenum": "interaction_type", "adr_profile": "profile"}

# CSV-era hit log: 8 columns, header, ';' separated.
CSV_HIT_COLUMNS = ("ProjectID", "ClientID", "HitTimeStamp", "ga_sourcemedium",
                   "utm_source", "ga_location", "goal", "src")
