"""Plans made of operators: ingest, enrichment, publication and reports."""
