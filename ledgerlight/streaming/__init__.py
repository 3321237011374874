"""Keeping facts up to date without rebuilding them."""
