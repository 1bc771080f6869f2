"""Column functions: built-in expressions only, apart from the one Arrow scorer in ``fuzzy``."""
