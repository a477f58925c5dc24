"""Registered queries: the operators run on the supplied tables, with reference SQL."""
