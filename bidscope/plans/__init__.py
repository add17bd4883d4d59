"""Report composition: requests, rules and the report tables."""
