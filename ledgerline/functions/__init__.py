"""Column rules: every function takes and returns a Column (JVM expressions only)."""
