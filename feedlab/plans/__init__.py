"""Whole jobs: the daily load, the reports and the alerts."""
