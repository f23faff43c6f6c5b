"""Jobs and queries: ingest, dashboard KPIs, news, sentiment, forecast features and baselines, monitoring."""
