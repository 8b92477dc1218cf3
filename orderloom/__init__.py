"""Sales-mart pipeline on Spark: staging, star schema, quality rules, reports."""
