"""Compositions: the layered pipeline, the SQL surface, and the registered queries."""
