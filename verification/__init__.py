"""Registered queries and their independent SQL, both over the star-schema test tables."""
