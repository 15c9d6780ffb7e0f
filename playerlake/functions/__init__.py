"""functions of playerlake."""
