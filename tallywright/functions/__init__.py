"""Column expressions shared by the operators; all but the wide distance kernel stay in the JVM."""
