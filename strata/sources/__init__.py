"""Readers and writers: raw files, typed files and catalog tables."""
