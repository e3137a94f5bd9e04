"""Column builders made of built-in Spark functions only."""
