"""Operators: DataFrame in, DataFrame out, no action unless the docstring says so."""
