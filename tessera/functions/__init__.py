"""Column -> Column function libraries."""
