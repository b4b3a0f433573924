"""Row-wise column expressions; all run inside the JVM."""
