"""Type conversions and Avro schemas."""
