"""Settings for the default entity, places with an id, a type and a location.

All names here are fixed values: they are the field names of the source records.
"""

from tierbed.operators.curate import FillRule

PLACE_SCHEMA = (
    "id string, name string, brewery_type string, country string, state string, "
    "state_province string, city string"
)
PLACE_RULES = (
    FillRule("country", ("country",)),
    FillRule("state_province", ("state_province", "state")),
    FillRule("city", ("city",)),
)
# Runs and countries are directories; within a file rows are sorted by place.
SILVER_PARTITIONS = ("ingestion_run_id", "country")
SILVER_SORT = ("state_province", "city")
GOLD_KEYS = ("country", "state_province", "city", "brewery_type")
GOLD_COUNT = "brewery_count"
