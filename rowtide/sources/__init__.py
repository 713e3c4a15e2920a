"""Readers, writers and the stored tables between jobs."""
