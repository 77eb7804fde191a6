"""Reading, staging, publishing and catalog registration."""
