"""Column expressions. All run inside the JVM except the similarity ratio in ``similarity``."""
