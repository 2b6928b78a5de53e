"""Sources: driver tables, the readings fixture, topic and landing-file sources."""
