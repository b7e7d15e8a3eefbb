"""DataFrame-to-DataFrame operators; none reads a clock or writes a file."""
