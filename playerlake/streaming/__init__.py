"""streaming of playerlake."""
