"""Table operators for raw -> curated -> aggregated pipelines on Spark."""
