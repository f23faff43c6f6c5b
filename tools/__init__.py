"""Development tools: DuckDB oracle SQL, side-by-side checker, plan report."""
