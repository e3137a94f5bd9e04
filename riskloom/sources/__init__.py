"""Readers, sinks, staged tables and sampling."""
