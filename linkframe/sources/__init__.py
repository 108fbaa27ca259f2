"""Where the data comes from: mapped tables, triples, files, endpoints."""
