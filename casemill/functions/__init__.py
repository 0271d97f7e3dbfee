"""Column expressions: JVM-side built-ins only, safe with ANSI mode on."""
