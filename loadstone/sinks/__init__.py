"""Outputs: ORC, tables, gzip CSV and SequenceFile."""
