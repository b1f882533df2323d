"""Jobs and the two steps that run them."""
