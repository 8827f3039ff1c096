"""Readers of labelled lines, plain messages, tables and scoring requests."""
