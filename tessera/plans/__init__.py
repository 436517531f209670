"""Pipelines, views, checks and measures of the mart."""
