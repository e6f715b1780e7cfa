"""DataFrame -> DataFrame operators of the claims warehouse."""
