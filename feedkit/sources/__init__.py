"""Where feeds come from and where they go."""
