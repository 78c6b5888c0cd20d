"""Operators: DataFrame → DataFrame functions over raw lines and the star."""
