"""Inputs (corpus/query/judgment adapters, driver test tables, fixture) and presentation sinks."""
