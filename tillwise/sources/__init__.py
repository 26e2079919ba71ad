"""Readers: files, JSON documents, keyed lookups and the star-schema adapter."""
