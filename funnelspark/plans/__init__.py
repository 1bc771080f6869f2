"""Jobs and named queries composed from the operators."""
