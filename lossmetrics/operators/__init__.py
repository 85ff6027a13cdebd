"""Operators: claims DataFrame in, tidy DataFrame out, no action inside."""
