"""Readers: event topics, star-schema tables, landing helpers and file layout."""
