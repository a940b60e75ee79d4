"""Readers, writers and the folder layout of a run."""
