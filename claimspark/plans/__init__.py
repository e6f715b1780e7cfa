"""Report marts, the pipeline and the query catalog."""
