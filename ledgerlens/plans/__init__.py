"""Tables and reports: staging, dimensions, facts, marts and analyses."""
