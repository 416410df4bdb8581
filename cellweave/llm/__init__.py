"""Preparing training text: archives, filters, near copies, decontamination, formatting and mixing."""
