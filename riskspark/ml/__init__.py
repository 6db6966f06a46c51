"""Learning jobs: Spark ML models, the isolation forest, attribution."""
