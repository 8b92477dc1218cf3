"""Where data comes from: CSV files, driver tables, a published mart."""
