"""Both hops over files that keep arriving."""
