"""Sources and the versioned table store."""
