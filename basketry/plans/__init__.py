"""The named analyses. Each takes flat tables and returns a DataFrame."""
