"""End-to-end pipelines of the reference."""
