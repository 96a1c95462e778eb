"""Readers and writers for tables and models."""
