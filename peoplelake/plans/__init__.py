"""Compositions: the model chain, the daily run and the star-schema binding."""
