"""fieldkit.functions."""
