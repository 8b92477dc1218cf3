"""The pipeline bound to the trade tables, and the SQL each result must equal."""
