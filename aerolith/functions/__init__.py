"""Column functions: geodesy, cells, memberships."""
