"""Compositions of the operators: incremental upsert and the full bronze-to-gold run."""
