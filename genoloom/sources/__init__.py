"""Readers and writers. Parsing of lines is separate from reading, so any text source can be parsed."""
