"""Where the logical tables come from."""
