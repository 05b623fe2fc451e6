"""Readers, schemas, yearly lookups and fixture views."""
