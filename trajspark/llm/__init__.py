"""Operators for building training corpora. Nothing outside this subpackage imports it; its tables are ``documents``, ``pages`` and ``labels``."""
