"""Readers: seeds, stored pages, word lists, datasets, logs, metrics."""
