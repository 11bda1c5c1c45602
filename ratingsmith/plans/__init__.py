"""Composed plans: the query catalogue, the star-schema build and the refresh run."""
