"""Readers and writers of the tables that stages exchange."""
