"""Reading input tables, and writing intermediate ones."""
