"""Jobs started by newly arrived files."""
