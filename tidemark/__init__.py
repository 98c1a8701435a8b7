"""Contract-driven master tables, splits, features, models and monitoring as Spark jobs."""
