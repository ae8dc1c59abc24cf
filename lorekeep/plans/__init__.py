"""Compositions: building a graph from documents, and answering queries from it."""
