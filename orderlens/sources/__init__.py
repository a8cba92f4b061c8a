"""Readers, writers, scratch tables and the run registry."""
