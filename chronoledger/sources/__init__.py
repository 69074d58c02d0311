"""Table access: the versioned table store and the test-data stand-ins."""
