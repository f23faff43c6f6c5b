"""Reusable operators Spark lacks: as-of join, skew-safe ordered series, tie-aware modes, per-group scaling."""
