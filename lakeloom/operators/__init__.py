"""DataFrame -> DataFrame operators of the lakehouse."""
