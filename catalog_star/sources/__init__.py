"""CSV, JDBC and warehouse sources."""
