"""End-to-end reports: each function takes tables and returns named report tables."""
