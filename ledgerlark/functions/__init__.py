"""Column-expression helpers (JVM-side unless noted)."""
