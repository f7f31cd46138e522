"""Sources, sinks and staging tables."""
