"""Report pipelines and the registered queries."""
