"""Plans: adapters from the given tables, chart datasets, ingest flow, query registry."""
