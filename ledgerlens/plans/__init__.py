"""Named reports and their oracle SQL."""
