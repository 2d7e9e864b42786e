"""Readers, sinks and table maintenance."""
