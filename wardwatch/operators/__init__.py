"""DataFrame -> DataFrame operators of the readings pipeline."""
