"""Learner-course interaction analytics on Spark.

Pure ``DataFrame -> DataFrame`` operators live in :mod:`coursepulse.operators`; sources, sinks
and streaming helpers only move data in and out of them.
"""
