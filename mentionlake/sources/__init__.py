"""Readers and writers: JSON lines, long-window zstd, listing files, reference lists, CSV."""
