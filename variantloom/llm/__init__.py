"""Operators for large training corpora: one module each, with queries in `queries`."""
