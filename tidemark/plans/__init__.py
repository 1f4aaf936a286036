"""Composed plans: the lakehouse model, the pipeline and the registered queries."""
