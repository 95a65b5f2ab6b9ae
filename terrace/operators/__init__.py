"""DataFrame operators and table writes."""
