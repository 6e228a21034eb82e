"""Streaming.

The reference reads every input as a batch file and has no stream source,
watermark, window or state, so there is no streaming operator here.
"""
