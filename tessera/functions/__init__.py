"""Column functions over wire terms, and the registry of named transforms and filters."""
