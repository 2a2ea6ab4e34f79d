"""Operators put together: change log -> documents, and the registered queries."""
