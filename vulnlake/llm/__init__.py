"""Operators for large training corpora: one module per operator, their registered queries in `queries`."""
