"""Readers, writers, payload parsing and the table views used by the registered queries."""
