"""DataFrame-to-DataFrame operators, each usable on its own."""
