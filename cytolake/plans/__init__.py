"""Composed pipelines and the projections of the driver's tables that the queries run on."""
