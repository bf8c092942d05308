"""Price-monitoring analytics for product listings, written for Apache Spark."""
