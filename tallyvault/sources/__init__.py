"""Sources and sinks: fixture views, CSV staging, JDBC options."""
