"""The three jobs: build the warehouse, run the analytics, prepare the report tables."""
