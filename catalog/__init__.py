"""Registered queries: the library run over the supplied tables, and the SQL each must agree with."""
