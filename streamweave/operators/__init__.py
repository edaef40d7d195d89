"""Bounded (batch) forms of the reference's operators."""
