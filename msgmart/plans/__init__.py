"""Job specifications and the runner that executes them."""
