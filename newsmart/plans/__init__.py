"""Whole-job plans and the registered queries."""
