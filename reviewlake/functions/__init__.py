"""Column functions: ``Column -> Column``, evaluated inside the JVM."""
