"""fieldkit.operators."""
