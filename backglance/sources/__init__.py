"""Reading, staging and counting tables."""
