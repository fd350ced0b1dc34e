"""Typed table reads, increments and daily-partition writes."""
