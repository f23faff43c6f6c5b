"""Readers: quarter-folder TSV, CSV exports, zip archives, wide price downloads, HTML pages, stored tables."""
