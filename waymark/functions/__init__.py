"""Column expressions: no function here triggers a job or leaves the JVM, except similarity."""
