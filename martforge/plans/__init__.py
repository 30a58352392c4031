"""Composed jobs: the retail specs, the medallion pipeline and the registered queries."""
