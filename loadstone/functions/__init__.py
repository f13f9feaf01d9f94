"""Column functions: decoding, tests and formatting."""
