"""Readers and writers: the only modules that know paths."""
