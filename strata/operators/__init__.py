"""DataFrame -> DataFrame operators; each one a declarative Spark plan."""
