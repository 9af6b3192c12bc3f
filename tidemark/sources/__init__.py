"""Readers for landing files and stored tables."""
