"""DataFrame -> DataFrame operators: staging, metrics, upserts, quality, reports, export, Arrow variants."""
