"""The production record that all catalogues are read into."""

PRODUCTION_COLUMNS = (
    "key", "source", "show_title", "organization", "venue", "venue_type", "street", "city", "state", "postal", "country",
    "lat", "lng", "start_date", "end_date", "source_url", "org_website", "seq",
)
