"""Row quality, grouped statistics and reuse of stored results."""
