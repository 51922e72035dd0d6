"""Training-data operators. Nothing outside this package (and its entry point) imports it."""
