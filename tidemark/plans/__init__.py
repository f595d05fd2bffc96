"""Composed jobs: the medallion flows, the query catalog, maintenance."""
