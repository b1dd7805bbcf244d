"""Sales mart on Spark: conform several operational sources into one star
schema, load it idempotently, and answer business questions on it."""
