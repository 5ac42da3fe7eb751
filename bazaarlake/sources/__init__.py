"""Readers, writers, event sources and the SQL surface."""
