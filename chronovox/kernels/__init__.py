"""Numeric kernels on numpy arrays; no Spark here."""
