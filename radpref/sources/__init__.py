"""Reading events and writing output rows."""
