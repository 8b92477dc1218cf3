"""The pipeline's plans: star, issues, checks, reports, publishing."""
