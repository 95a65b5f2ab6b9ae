"""Whole flows made of the operators: ingest runs, Silver and Gold refreshes."""
