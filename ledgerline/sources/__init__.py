"""Inputs (schemas, readers, TPC-H-derived fixtures) and report sinks."""
