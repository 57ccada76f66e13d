"""Whole pipelines: the star schema from reports, and the registered queries."""
