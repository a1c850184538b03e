"""Reading and writing: CSV sources, snapshot tables, models, run records."""
