"""File sources, sinks and generators."""
