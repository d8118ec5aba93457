"""Readers. Files are opened by Spark alone; a task parses the bytes of the file it was given."""
