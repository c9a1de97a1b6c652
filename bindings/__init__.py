"""The operators bound to the given tables: one query and one oracle SQL per entry."""
