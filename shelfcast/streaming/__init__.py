"""Deliberately empty: every input of this workload is a finished file.

There is no stream, watermark or late data to handle, so the package is batch
only (see the README).
"""
