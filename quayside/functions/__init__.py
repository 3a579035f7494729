"""Column expressions: text, calendar and numeric. All are JVM built-ins."""
