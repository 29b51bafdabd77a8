"""Registered queries: operators composed over the star-schema tables."""
