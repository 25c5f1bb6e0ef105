"""Reads: tables, landing files, audit logs, change feeds and test tables."""
