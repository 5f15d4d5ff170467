"""Reading input tables and publishing reports."""
