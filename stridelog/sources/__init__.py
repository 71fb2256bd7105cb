"""Readers, sinks and checks of tables."""
