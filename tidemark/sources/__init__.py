"""Streams to read and tables to write."""
