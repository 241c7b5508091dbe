"""Column expressions. Everything runs JVM-side except two small Arrow UDFs."""
