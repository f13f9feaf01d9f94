"""The two jobs: load and export."""
