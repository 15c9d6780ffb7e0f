"""plans of playerlake."""
