"""Readers for the filing inputs (files landed by any downloader)."""
