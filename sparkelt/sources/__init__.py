"""Where data comes from and where model tables live."""
