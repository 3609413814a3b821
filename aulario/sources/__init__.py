"""Readers of cell grids and form tables, and the writers behind each refresh."""
