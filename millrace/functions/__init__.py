"""Column functions: operation types, codecs, clamped arithmetic, retry delays."""
