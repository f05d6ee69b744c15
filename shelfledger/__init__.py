"""Retail inventory analytics as plain DataFrame-to-DataFrame functions."""
