"""Whole jobs, from lines to scores or anomalies."""
