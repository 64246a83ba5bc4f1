"""Compositions of stages, the query catalogue and its SQL."""
