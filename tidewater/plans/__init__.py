"""Query plans by subject; ``registry`` names them."""
