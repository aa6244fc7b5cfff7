"""Column expressions (P*, D*): pure, built-in, usable in batch and stream."""
