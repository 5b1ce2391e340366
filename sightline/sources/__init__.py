"""Readers and writers: tables, JSON lines, archive files and their audit."""
