"""Fail-closed change-data-capture analytics as Spark plans."""
