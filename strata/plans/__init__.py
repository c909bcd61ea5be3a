"""Stage pipeline, driver-table mapping, driver queries and their oracle SQL."""
