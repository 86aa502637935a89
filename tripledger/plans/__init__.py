"""The trip data: raw, silver and gold tables, questions and reports."""
