"""Column functions: numbers, paths, dates in names, crops and texts."""
