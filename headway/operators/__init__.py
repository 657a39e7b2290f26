"""DataFrame-to-DataFrame operators; columns are arguments."""
