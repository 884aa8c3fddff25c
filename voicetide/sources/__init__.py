"""Readers and writers: landed JSON, post tables, the analytics document."""
