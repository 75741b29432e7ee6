"""Where comments come from: raw lines (files, Kafka), tables, and the events fixture."""
