"""Feeds that arrive while a query runs."""
