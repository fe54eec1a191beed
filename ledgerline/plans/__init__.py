"""Stage chains, the staged batch run, and the registry of named queries."""
