"""Readers for the article tables and the adapter views over the test tables."""
