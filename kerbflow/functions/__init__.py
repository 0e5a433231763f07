"""Column expressions. All of them are built-in Spark functions, so they stay inside code generation."""
