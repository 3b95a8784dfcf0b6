"""Readers for the daily files, the source snapshots and the control table."""
