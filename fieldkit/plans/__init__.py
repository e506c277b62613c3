"""fieldkit.plans."""
