"""Jobs that put the operators together over a stored warehouse."""
