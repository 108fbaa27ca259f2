"""Tables, fields and keys: declared, read from shapes, or discovered."""
