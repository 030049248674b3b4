"""Metadata-driven file staging and load observability as Spark DataFrame jobs.

``functions``  Column expressions (paths, names, dates, types, text)
``sources``    scans, listings and sinks
``operators``  DataFrame -> DataFrame building blocks
``plans``      configuration model, staging run, monitoring loop
``streaming``  continuous ingest of arriving files
"""
