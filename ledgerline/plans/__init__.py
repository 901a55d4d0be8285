"""Registered jobs over the provided tables and their oracle SQL."""
