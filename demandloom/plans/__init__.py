"""How stages are wired together, and the catalogue of named queries."""
