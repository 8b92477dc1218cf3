"""Relational building blocks shared by the star, the checks and the reports."""
