"""Column expressions for cleaning, and the page reader."""
