"""Readers for dumps, crawl batches and checkpoints; verified table writers."""
