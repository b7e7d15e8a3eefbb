"""Reading and writing: landing files, plain tables, versioned tables."""
