"""Operators: silver transforms, dedupe, upserts, dimensions, fact, marts, quality, tracker, sinks."""
