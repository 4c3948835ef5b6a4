"""Whole analyses, bindings of the test tables and the registered queries with their SQL."""
