"""Readers: delimited files, JSON documents, listing pages, opaque files."""
