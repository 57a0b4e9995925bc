"""End-to-end jobs: each reads, cleans, derives and writes or scores one kind of data."""
