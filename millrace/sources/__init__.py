"""Readers for the delivered formats, and one landing function per feed."""
