"""Composed programs, driver stand-in inputs and the driver query registry."""
