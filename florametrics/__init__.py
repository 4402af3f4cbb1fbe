"""Microbiome and microbial-genomics analytics expressed as Spark DataFrame plans."""
