"""Whole pipelines: source -> bronze -> silver, silver -> gold -> marts."""
