"""Readers for tool outputs and writers for tables, CSV and FASTA."""
