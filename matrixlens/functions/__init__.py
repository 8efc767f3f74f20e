"""Column-level helpers: names, types, missing values, globs and nested paths."""
