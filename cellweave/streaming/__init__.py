"""Incremental runs over images that arrive while earlier ones are already done."""
