"""Operators on streams: sinks that survive a restart, and what they leave behind."""
