"""operators of playerlake."""
