"""Operators of a training-data pipeline: cleaning, deduplication, classifiers and mixing over documents and pages."""
