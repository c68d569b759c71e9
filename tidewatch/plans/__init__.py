"""Dimensions, facts, marts and reports, composed from the operators."""
