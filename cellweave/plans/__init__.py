"""Whole analyses built from the operators; every result is a lazy DataFrame."""
