"""Column functions over RDF terms and text rendering of terms."""
