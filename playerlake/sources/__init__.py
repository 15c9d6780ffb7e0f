"""sources of playerlake."""
