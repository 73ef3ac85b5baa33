"""DataFrame -> DataFrame steps."""
