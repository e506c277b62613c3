"""fieldkit.sources."""
