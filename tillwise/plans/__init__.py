"""Enrichment and the whole job, composed from the operators."""
