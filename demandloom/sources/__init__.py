"""Reading source tables, writing results, fixed parameter tables."""
