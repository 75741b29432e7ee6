"""Where results go: text lines, tables, Kafka messages, the console, the author record."""
