"""Market-data operators as DataFrame functions (no state, no driver loops)."""
