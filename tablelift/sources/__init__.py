"""Sources: files, views and JDBC databases; the Avro file writer."""
