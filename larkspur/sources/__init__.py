"""Readers and writers for tables, models, arrays, binary objects and metric points."""
