"""Column functions of the timeline operators."""
