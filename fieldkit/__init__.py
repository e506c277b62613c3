"""fieldkit: DataFrame operators for tables, text, pages and location-stamped events."""
