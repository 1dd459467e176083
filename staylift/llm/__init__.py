"""Corpus preparation: one module per operator, each reading a documents table of any size."""
