"""Sources, sinks and the layer catalog."""
