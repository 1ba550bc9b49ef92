"""Operators for large text training corpora, each built by one stated method; nothing else in the library imports them."""
