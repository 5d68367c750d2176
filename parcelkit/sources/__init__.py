"""Readers: yearly text files, codebook, ZIP archives, download pages."""
